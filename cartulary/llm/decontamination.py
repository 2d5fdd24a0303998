"""Benchmark items inside documents: size-partitioned MinHash search, then exact containment.

DataFrame operations only. An item is looked for by its sketch, the smallest hashes of its word
shingles. The sketch's length depends on the item's size partition (up to 1, 2, 4, 8, ... shingles):
one more than an item of that partition may lack in a document that contains it. So a document that
contains the item holds part of the sketch for certain, and how much of it bounds the candidates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartulary.llm.common import KeyFilter, documents_of, restored, stored

WORDS = 5
#: Containment in per cent of the item's shingles.
PER_CENT = 80
#: Rows of sketches that may be broadcast; longer lists are joined by shuffling.
BROADCAST_ROWS = 300_000


def words_of(text: Column) -> Column:
    """Runs of letters and digits, in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))


def _shingles(table: DataFrame, words: int, hashed: bool) -> DataFrame:
    """Replaces ``text`` by ``shingles``: of all word n-grams, or of the whole sequence if shorter."""
    if not hashed:
        # Exact: the words themselves.
        spoken = table.withColumn("_words", words_of("text"))
        grams = F.transform(
            F.sequence(F.lit(1), F.greatest(F.size("_words") - (words - 1), F.lit(1))),
            lambda k: F.concat_ws(" ", F.slice(F.col("_words"), k, F.lit(words))),
        )
    else:
        spoken = table.withColumn("_words", F.transform(words_of("text"), lambda w: F.xxhash64(w)))
        grams = F.transform(
            F.sequence(F.lit(0), F.greatest(F.size("_words") - words, F.lit(0))),
            # A place after the last word gives null, which the hash passes over.
            lambda k: F.xxhash64(*[F.get("_words", k + n) for n in range(words)]),
        )
    return spoken.withColumn(
        "shingles", F.when(F.size("_words") > 0, grams).otherwise(F.array().cast("array<bigint>" if hashed else "array<string>"))
    ).drop("_words", "text")


def sketches(items: DataFrame, words: int, per_cent: int) -> DataFrame:
    """``_item, hash, least``: an item's sketch, and how many of it a document that has the item holds."""
    sized = _shingles(items, words, hashed=True).withColumn("shingles", F.array_sort(F.array_distinct("shingles"))).withColumn(
        "_size", F.size("shingles")
    )
    partition = F.pow(F.lit(2), F.ceil(F.log2("_size"))).cast("int")
    lacking = F.floor(F.lit(100 - per_cent) * F.col("_size") / 100).cast("int")
    sized = sized.withColumn(
        "_length", F.least(F.floor(F.lit(100 - per_cent) * partition / 100).cast("int") + 1, F.col("_size"))
    )
    return sized.select(
        "_item", F.explode_outer(F.slice("shingles", F.lit(1), F.col("_length"))).alias("hash"),
        (F.col("_length") - lacking).alias("least"),
    ).where("hash is not null")


def contaminated(documents: DataFrame, benchmark: DataFrame, words: int = WORDS, per_cent: int = PER_CENT) -> DataFrame:
    """``doc_id, item_id, n_item, n_shared, containment`` of documents that contain an item.

    ``documents(doc_id, text)`` and ``benchmark(item_id, text)``; an item is contained if at least
    ``per_cent`` of its distinct word shingles are in the document. Words are runs of letters and
    digits, without case; a text of fewer words than a shingle is one shingle, and one without
    words, empty or null contains nothing and is contained nowhere. Ids may be null or repeat: rows
    count each for itself, but equal item rows count once. Other columns are ignored.
    """
    return _pairs(documents, benchmark, words, per_cent).select("doc_id", "item_id", "n_item", "n_shared", "containment")


def _pairs(documents: DataFrame, benchmark: DataFrame, words: int, per_cent: int) -> DataFrame:
    texts = documents_of(documents)
    items = documents_of(benchmark, "item_id").select(
        F.col("doc_id").alias("item_id"), F.col("_row").alias("_item"), "text"
    ).distinct()
    sketch = stored(sketches(items, words, per_cent), "sketches")
    small = sketch.count() <= BROADCAST_ROWS
    # An inner explode would be given a filter that is pushed below and computes the shingles again.
    found = _shingles(texts, words, hashed=True).select("doc_id", "_row", F.explode_outer("shingles").alias("_hash")).join(
        F.broadcast(sketch) if small else sketch, F.col("_hash") == F.col("hash")
    )
    candidates = stored(
        found.groupBy("doc_id", "_row", "_item").agg(
            F.count_distinct("hash").alias("held"), F.max("least").alias("least")
        ).where("held >= least").select(F.col("doc_id").alias("_doc"), F.col("_row").alias("_key"), "_item"),
        "candidates",
    )
    exact = _shingles(items, words, hashed=False).select(
        "item_id", F.col("_item").alias("_own"), F.array_distinct("shingles").alias("_wanted")
    )
    pairs = candidates.join(exact, F.col("_item") == F.col("_own"))
    likely = KeyFilter(candidates, "_key", "candidate-keys").mark(texts, "_row").where("_passes")
    joined = likely.join(pairs, (F.col("_row") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_doc")))
    verified = _shingles(joined, words, hashed=False).select(
        "doc_id", "_row", "item_id", F.size("_wanted").alias("n_item"),
        F.size(F.array_intersect("_wanted", "shingles")).alias("n_shared"),
    )
    return stored(verified, "verified").where(F.col("n_shared") * 100 >= F.col("n_item") * per_cent).withColumn(
        "containment", F.col("n_shared") / F.col("n_item")
    )


def without_contaminated(documents: DataFrame, benchmark: DataFrame, words: int = WORDS, per_cent: int = PER_CENT) -> DataFrame:
    """The rows of ``documents`` that contain no item, with all their columns."""
    found = stored(
        _pairs(documents, benchmark, words, per_cent).select(F.col("doc_id").alias("_doc"), F.col("_row").alias("_key")).distinct(),
        "contaminated",
    )
    told = KeyFilter(found, "_key", "contaminated-keys").mark(documents_of(documents, carry=True), "_row")
    clean = told.where("_passes").join(
        found, (F.col("_row") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_doc")), "left_anti"
    )
    kept = told.where("not _passes").select("_carried", "text").unionByName(clean.select("_carried", "text"))
    return restored(kept, documents.columns)


#: Exact containment by joining all shingles.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents
), i AS (
  SELECT DISTINCT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark
), ds AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 2)), lambda k: array_to_string(w[k:k + 4], ' '))) AS s
  FROM d WHERE len(w) > 0
), s AS (
  SELECT DISTINCT item_id, unnest(list_transform(range(1, greatest(len(w) - 3, 2)), lambda k: array_to_string(w[k:k + 4], ' '))) AS s
  FROM i WHERE len(w) > 0
), n AS (SELECT item_id, count(*) AS n_item FROM s GROUP BY item_id)
SELECT doc_id, item_id, CAST(n_item AS INTEGER) AS n_item, CAST(count(*) AS INTEGER) AS n_shared,
  CAST(count(*) AS DOUBLE) / n_item AS containment
FROM ds JOIN s USING (s) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_item HAVING count(*) * 100 >= n_item * 80
"""
