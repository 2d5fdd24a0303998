"""Hard negatives: for anchors and their best positives, rows of other labels with a score in between.

Scores are exact integer inner products. Vectors are dealt into buckets by their length, and buckets
into blocks of a bounded number of rows, each with its coordinates as sorted lists. An anchor needs
a least score in a block: the score of the last of the rows that it would return, known from a
sample, or the window's lower end. Divided by the anchor's length and the bucket's largest one, that
is a least cosine, and with it the anchor's largest coordinates (its focus) have ranges of values
that a row must have in each. The sorted lists give the rows in those ranges; what is in all of them
is scored exactly. The sample only tells where to start: a poor one costs time, never a row.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cartulary.llm.common import stored

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: A negative's score, in per cent of the positive's.
LOW, HIGH = 30, 90
#: Rows of a block, and anchors that a block meets in one task.
BLOCK, ANCHORS = 8192, 4096
#: Rows, drawn by a hash, whose scores give an anchor its first least score.
SAMPLE = 4096
FOCUS = 4
#: Vectors of this integer length or more would not keep a hundred times a score in 64 bits.
LONGEST = 1 << 28
_NOTHING = np.iinfo(np.int64).min


def usable(table: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, label, x`` (integers), ``square`` (of the length) of the rows that take part, each once."""
    doubles = F.col("embedding").cast("array<double>")
    plain = F.forall(doubles, lambda c: c.isNotNull() & (F.abs(c) < LONGEST / scale))  # NaN is larger than any number
    small = table.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0) & plain)
    whole = small.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.transform(doubles, lambda c: F.floor(c * F.lit(float(scale))).cast("int")).alias("x"),
    )
    square = F.aggregate("x", F.lit(0.0), lambda total, c: total + c.cast("double") * c.cast("double"))
    return whole.distinct().withColumn("square", square).where(F.col("square") < float(LONGEST) ** 2)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.int32).reshape(-1, width)


@dataclass
class Anchors:
    """Anchors, the windows ``(lower, upper)`` of scores that each looks for, and how many rows in each."""

    keys: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray
    lower: np.ndarray  # anchors by windows
    upper: np.ndarray


class Block:
    """Rows of about one length, with sorted coordinate lists."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, focus: int = FOCUS) -> None:
        self.ids, self.labels, self.x, self.focus = ids, labels, x.astype(np.float64), focus
        self.length = np.sqrt((self.x**2).sum(1))
        self.unit = self.x / np.where(self.length > 0, self.length, 1.0)[:, None]
        self.most = float(self.length.max(initial=0.0))
        self.least = float(self.length.min(initial=0.0))
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _list(self, coordinate: int) -> tuple[np.ndarray, np.ndarray]:
        """A coordinate's values in order, and the rows that have them."""
        if coordinate not in self.lists:
            order = np.argsort(self.unit[:, coordinate], kind="stable")
            self.lists[coordinate] = (self.unit[order, coordinate], order)
        return self.lists[coordinate]

    def candidates(self, anchor: np.ndarray, lower: int) -> np.ndarray | None:
        """Rows whose score with the anchor can reach ``lower``; None for all rows."""
        own = float(np.sqrt((anchor.astype(np.float64) ** 2).sum()))
        if lower <= 0 and (self.least == 0 or own == 0):
            return None
        reach = own * (self.most if lower > 0 else self.least)
        if reach == 0:
            return np.zeros(0, np.int64)
        cosine = lower / reach - 1e-9
        if cosine > 1:
            return np.zeros(0, np.int64)
        if cosine <= -1:
            return None
        open_angle = np.arccos(cosine)
        unit = anchor / own
        ranges = []
        for coordinate in np.argsort(-np.abs(unit), kind="stable")[: self.focus].tolist():
            angle = np.arccos(np.clip(unit[coordinate], -1, 1))
            low, high = np.cos(min(np.pi, angle + open_angle)) - 1e-9, np.cos(max(0.0, angle - open_angle)) + 1e-9
            values, _ = self._list(coordinate)
            a, b = np.searchsorted(values, low, "left"), np.searchsorted(values, high, "right")
            ranges.append((int(b - a), coordinate, int(a), int(b), low, high))
        ranges.sort()
        many, coordinate, a, b, _, _ = ranges[0]
        if many == len(self.ids):
            return None
        rows = self._list(coordinate)[1][a:b]
        for _, coordinate, _, _, low, high in ranges[1:]:
            value = self.unit[rows, coordinate]
            rows = rows[(value >= low) & (value <= high)]
        return rows

    def scores(self, anchor: np.ndarray, rows: np.ndarray | None) -> np.ndarray:
        """Exact scores: doubles hold every sum where lengths multiply to less than 2^53."""
        x = self.x if rows is None else self.x[rows]
        own = anchor.astype(np.float64)
        if np.sqrt((own**2).sum()) * self.most < 2**53:
            return (x @ own).astype(np.int64)
        return (x.astype(np.int64) * anchor.astype(np.int64)).sum(1)

    def best(self, anchors: Anchors, same_label: bool, many: int) -> tuple[np.ndarray, ...]:
        """``(place of the anchor, window, vec_id, score)`` of the first ``many`` rows of each window here."""
        found: list[tuple[np.ndarray, ...]] = []
        for place in range(len(anchors.ids)):
            lower, upper = anchors.lower[place], anchors.upper[place]
            asked = np.flatnonzero(lower <= upper)
            if not len(asked):
                continue
            rows = self.candidates(anchors.x[place], int(lower[asked].min()))
            labels = self.labels if rows is None else self.labels[rows]
            fits = (labels == anchors.labels[place]) == same_label
            fits &= (self.ids if rows is None else self.ids[rows]) != anchors.ids[place]
            rows = np.flatnonzero(fits) if rows is None else rows[fits]
            if not len(rows):
                continue
            score = self.scores(anchors.x[place], rows)
            for window in asked.tolist():
                inside = np.flatnonzero((score >= lower[window]) & (score <= upper[window]))
                if len(inside) > 4 * many:  # ties with the last one stay
                    inside = inside[score[inside] >= -np.partition(-score[inside], many - 1)[many - 1]]
                inside = inside[np.lexsort((self.ids[rows[inside]], -score[inside]))[:many]]
                size = len(inside)
                found.append((np.full(size, place), np.full(size, window), self.ids[rows[inside]], score[inside]))
        if not found:
            return tuple(np.zeros(0, np.int64) for _ in range(4))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _lists(values: np.ndarray) -> pa.Array:
    flat = pa.array(np.ascontiguousarray(values).ravel())
    return pa.FixedSizeListArray.from_arrays(flat, values.shape[1]).cast(pa.list_(flat.type))


def _floor(sample: Block | None, anchors: Anchors, same_label: bool, many: int) -> np.ndarray:
    """Least scores: that of the ``many``-th row of each window in the sample, or the window's own."""
    lower = anchors.lower.copy()
    if sample is None or sample.x.shape[1] != anchors.x.shape[1]:
        return lower
    place, window, _, score = sample.best(anchors, same_label, many)
    spot = place * lower.shape[1] + window
    full = np.flatnonzero(np.bincount(spot, minlength=lower.size) >= many)
    last = np.full(lower.size, _NOTHING)
    np.minimum.at(all_scores := np.full(lower.size, np.iinfo(np.int64).max), spot, score)
    last[full] = all_scores[full]
    return np.maximum(lower, last.reshape(lower.shape))


class _Search:
    """A table's blocks, and searches of all anchors in all of them."""

    def __init__(self, spark: SparkSession, rows: DataFrame, block: int, share: int, sample: int) -> None:
        self.spark, self.share = spark, share
        width = F.size("x").alias("width")
        # Buckets of lengths within a quarter of an octave; zero vectors are one of their own.
        bucket = F.when(F.col("square") > 0, F.floor(F.log2("square") * 2).cast("int")).otherwise(F.lit(-1))
        keyed = rows.select("*", width, bucket.alias("bucket"))
        counts = keyed.groupBy("width", "bucket").agg(F.ceil(F.count("*") / block).alias("parts"))
        # A row for each length: at most 113 buckets of each number of components.
        sizes = stored(counts, "buckets")
        own = sizes.withColumnsRenamed({"width": "_width", "bucket": "_bucket"})
        self.rows = keyed.join(F.broadcast(own), (F.col("width") == F.col("_width")) & (F.col("bucket") == F.col("_bucket"))).withColumn(
            "part", F.pmod(F.xxhash64("vec_id", "x", "label"), F.col("parts"))
        ).drop("_width", "_bucket", "parts")
        self.blocks = sizes.select("width", "bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
        drawn = rows.select("vec_id", "label", "x").orderBy(F.xxhash64("vec_id", "x", F.lit(3)), "vec_id").limit(sample).collect()
        usual = len(drawn[0]["x"]) if drawn else 0
        drawn = [r for r in drawn if len(r["x"]) == usual]
        self.sample = [np.array([r[k] for r in drawn], t) for k, t in (("vec_id", np.int64), ("label", np.int64), ("x", np.int32))] if drawn else None

    def find(self, anchors: DataFrame, same_label: bool, many: int) -> DataFrame:
        """``key, window, vec_id, score``: the first ``many`` rows in each anchor's windows.

        ``anchors(key, vec_id, label, x, lower, upper)``: arrays of the windows' ends. Every anchor
        meets every block of vectors as long as itself; a task holds one block and ``share`` anchors.
        """
        sample = self.sample
        kinds = "key long, vec_id long, label long, x array<int>, lower array<long>, upper array<long>, width int"
        names = [k.strip().split(" ")[0] for k in kinds.split(",")]

        def raise_floor(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = Block(*sample) if sample else None
            for batch in batches:
                for own, asked in _groups(batch):
                    lower = _floor(known, asked, same_label, many)
                    yield pa.RecordBatch.from_arrays(
                        [*(own.column(n) for n in names[:4]), _lists(lower), own.column("upper"), own.column("width")], names
                    )

        ready = stored(anchors.withColumn("width", F.size("x")).mapInArrow(raise_floor, kinds), "anchors")
        # Anchors are dealt into shares; blocks are repeated for each share, anchors for each block.
        shares = ready.groupBy("width").agg(F.ceil(F.count("*") / self.share).alias("shares"))
        shares = stored(shares, "shares").withColumnRenamed("width", "_of")
        each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)).alias("share")
        nothing = F.array().cast("array<long>")
        base = self.rows.join(F.broadcast(shares), F.col("width") == F.col("_of")).select(
            "width", "bucket", "part", each, F.lit(0).alias("asks"), F.lit(None).cast("long").alias("key"), "vec_id", "label", "x",
            nothing.alias("lower"), nothing.alias("upper"),
        )
        dealt = ready.join(F.broadcast(shares), F.col("width") == F.col("_of")).withColumn(
            "share", F.pmod(F.xxhash64("key"), F.col("shares"))
        )
        asks = dealt.join(F.broadcast(self.blocks).withColumnRenamed("width", "_own"), F.col("width") == F.col("_own")).select(
            "width", "bucket", "part", "share", F.lit(1).alias("asks"), "key", "vec_id", "label", "x", "lower", "upper"
        )
        place = ["width", "bucket", "part", "share"]

        def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[tuple, list[pa.RecordBatch]] = {}
            now, block = None, None
            for batch in batches:
                for at, own in _split(batch, [*place, "asks"]):
                    if at[:-1] != now:
                        now, block, held = at[:-1], None, {}
                    if not at[-1]:
                        held.setdefault(now, []).append(own)
                        continue
                    if block is None:
                        if not held:
                            continue  # a block without rows
                        rows = pa.Table.from_batches(held.pop(now)).combine_chunks().to_batches()[0]
                        block = Block(
                            rows.column("vec_id").to_numpy(), rows.column("label").to_numpy(), _matrix(rows.column("x"), now[0])
                        )
                    for _, asked in _groups(own):
                        k, window, ids, score = block.best(asked, same_label, many)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(asked.keys[k]), pa.array(window.astype(np.int32)), pa.array(ids), pa.array(score)],
                            ["key", "window", "vec_id", "score"],
                        )

        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        met = base.unionByName(asks).repartition(parts, *place).sortWithinPartitions(*place, "asks")
        found = met.mapInArrow(search, "key long, window int, vec_id long, score long")
        order = Window.partitionBy("key", "window").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= many)


def _split(batch: pa.RecordBatch, keys: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """The runs of rows that are equal in ``keys``."""
    if not len(batch):
        return
    columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
    turns = np.zeros(len(batch), bool)
    turns[0] = True
    for column in columns:
        turns[1:] |= column[1:] != column[:-1]
    starts = np.flatnonzero(turns).tolist()
    for a, b in zip(starts, [*starts[1:], len(batch)], strict=True):
        yield tuple(int(column[a]) for column in columns), batch.slice(a, b - a)


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, Anchors]]:
    """Anchors of one number of components and of windows each."""
    if not len(batch):
        return
    windows = pc.list_value_length(batch.column("lower")).to_numpy(zero_copy_only=False)
    width = pc.list_value_length(batch.column("x")).to_numpy(zero_copy_only=False)
    for pair in np.unique(np.stack([width, windows], 1), axis=0).tolist():
        own = batch.take(pa.array(np.flatnonzero((width == pair[0]) & (windows == pair[1]))))
        ends = [pc.list_flatten(own.column(n)).to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(own), pair[1]) for n in ("lower", "upper")]
        yield own, Anchors(
            own.column("key").to_numpy(), own.column("vec_id").to_numpy(), own.column("label").to_numpy(),
            _matrix(own.column("x"), pair[0]), *ends,
        )


def mine(
    spark: SparkSession, table: DataFrame, is_anchor: Column, scale: int = SCALE, positives: int = POSITIVES,
    negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, block: int = BLOCK, share: int = ANCHORS, sample: int = SAMPLE,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``table`` has ``vec_id``, ``embedding`` and ``label``; ``is_anchor`` is a condition on ``vec_id``.
    Rows with a null id, label or vector, an empty vector, or a null or non-finite component, take no
    part, nor do vectors whose integer length is 2^28 or more (a hundred times their score need not fit 64
    bits). An anchor's positives are the ``positives`` rows of its label with the highest scores, its
    negatives for each the first ``negatives`` rows of other labels with ``low`` to ``high`` per cent
    of the positive's score; ties by the smaller id; fewer if there are fewer. Rows equal in id,
    vector and label count once; rows that share the anchor's id are not compared with it. Vectors
    of another length than the anchor's have no score with it. A negative positive score has an
    empty window. Other columns are ignored; an empty table gives no rows.
    """
    rows = stored(usable(table, scale), "vectors")
    search = _Search(spark, rows, block, share, sample)
    key = F.xxhash64("vec_id", "label", "x")
    anchors = rows.where(is_anchor).select(key.alias("key"), "vec_id", "label", "x")
    anything = F.array(F.lit(_NOTHING + 1)), F.array(F.lit(-_NOTHING - 1))
    nearest = stored(
        search.find(anchors.withColumns(dict(zip(("lower", "upper"), anything, strict=True))), True, positives).select(
            "key", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), F.col("rank").alias("place")
        ),
        "positives",
    )
    # At most so many positives of an anchor; those of one score share a window.
    wanted = nearest.groupBy(F.col("key").alias("_key")).agg(F.sort_array(F.collect_set("positive_score")).alias("scores"))
    asking = anchors.join(wanted, F.col("key") == F.col("_key")).select(
        "key", "vec_id", "label", "x",
        F.transform("scores", lambda s: F.ceil((s * low).cast("decimal(38,0)") / 100).cast("long")).alias("lower"),
        F.transform("scores", lambda s: F.floor((s * high).cast("decimal(38,0)") / 100).cast("long")).alias("upper"),
    )
    found = stored(search.find(asking, False, negatives).withColumnRenamed("key", "_found"), "negatives")
    windows = wanted.select("_key", F.posexplode("scores").alias("_window", "_score"))
    own = anchors.select(F.col("vec_id").alias("anchor_id"), F.col("key").alias("_anchor"))
    pairs = nearest.join(windows, (F.col("key") == F.col("_key")) & (F.col("positive_score") == F.col("_score")))
    pairs = pairs.join(own, F.col("key") == F.col("_anchor")).drop("_key", "_score", "_anchor")
    return pairs.join(found, (F.col("key") == F.col("_found")) & (F.col("_window") == F.col("window"))).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )


ORACLE = """
WITH u AS (
  SELECT DISTINCT CAST(vec_id AS BIGINT) AS vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE CAST(label AS BIGINT) END AS label,
    list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id, b.label, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, anchor_label, vec_id AS positive_id, score AS positive_score FROM s WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
  s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> s.anchor_label
  AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""
