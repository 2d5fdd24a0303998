"""Approximate nearest neighbours by learned partitions.

On a bounded sample, the graph of nearest neighbours is cut into balanced parts: parts grow from
well-spread seeds, then vectors move to the part that most of their neighbours are in, as long as
it has room. A small classifier learns to tell a vector's part. It deals every vector to its most
probable part, and sends a query to the several most probable ones, where all vectors are compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cartulary.llm.common import stored

#: Vectors that the graph and the classifier are fitted on, at most.
SAMPLE = 6000
NEIGHBOURS = 12
PARTS = 24
#: A query goes to its most probable parts until they hold this probability, and to so many at least.
PROBES, MASS = 6, 0.995
HIDDEN = 48
#: Vectors of a part that are compared in one task.
BLOCK = 20_000
#: Queries of a part that one task compares.
QUERIES = 4_096
#: Sampled vectors with larger components would overflow where they are squared; they teach nothing.
LARGEST = 1e60


def neighbour_graph(vectors: np.ndarray, many: int) -> np.ndarray:
    """The ``many`` nearest other vectors of each."""
    many = min(many, len(vectors) - 1)
    square = (vectors**2).sum(1)
    found = np.empty((len(vectors), many), np.int64)
    for first in range(0, len(vectors), 512):
        rows = slice(first, min(first + 512, len(vectors)))
        distance = square[None] - 2 * vectors[rows] @ vectors.T
        distance[np.arange(rows.stop - first), np.arange(first, rows.stop)] = np.inf
        found[rows] = np.argpartition(distance, many - 1, axis=1)[:, :many]
    return found


def balanced_parts(vectors: np.ndarray, graph: np.ndarray, parts: int, seed: int = 0, rounds: int = 12) -> np.ndarray:
    """A part for each vector: few edges between parts, and no part over 1.1 times its share."""
    size, draw = len(vectors), np.random.default_rng(seed)
    room = math.ceil(1.1 * size / parts)
    seeds = [int(draw.integers(size))]
    nearest = ((vectors - vectors[seeds[0]]) ** 2).sum(1)
    while len(seeds) < parts:
        seeds.append(int(draw.choice(size, p=nearest / nearest.sum())) if nearest.sum() > 0 else int(draw.integers(size)))
        nearest = np.minimum(nearest, ((vectors - vectors[seeds[-1]]) ** 2).sum(1))
    distance = (vectors**2).sum(1)[:, None] - 2 * vectors @ vectors[seeds].T
    part, held = np.full(size, -1), np.zeros(parts, np.int64)
    for row in np.argsort(distance.min(1) - distance.mean(1)).tolist():  # the surest first
        for choice in np.argsort(distance[row]).tolist():
            if held[choice] < room:
                part[row] = choice
                held[choice] += 1
                break
    back = [[] for _ in range(size)]
    for row, others in enumerate(graph.tolist()):
        for other in others:
            back[row].append(other)
            back[other].append(row)
    for _ in range(rounds):
        moved = 0
        for row in draw.permutation(size).tolist():
            votes = np.bincount(part[back[row]], minlength=parts)
            votes[(held >= room) & (np.arange(parts) != part[row])] = -1
            best = int(votes.argmax())
            if votes[best] > votes[part[row]]:
                held[part[row]] -= 1
                held[best] += 1
                part[row] = best
                moved += 1
        if moved < size / 200:
            break
    return part


class Router:
    """A classifier with one hidden layer: the probability of each part for a vector."""

    def __init__(self, vectors: np.ndarray, answers: np.ndarray, seed: int = 0, epochs: int = 25) -> None:
        """``answers``: for each vector, how its neighbours (and itself) spread over the parts."""
        draw = np.random.default_rng(seed)
        self.middle, self.scale = vectors.mean(0), vectors.std() + 1e-12
        x = (vectors - self.middle) / self.scale
        sizes = [x.shape[1], HIDDEN, answers.shape[1]]
        self.w = [draw.normal(0, (2 / a) ** 0.5, (a, b)) for a, b in zip(sizes, sizes[1:], strict=False)]
        self.b = [np.zeros(b) for b in sizes[1:]]
        held = [np.zeros_like(v) for v in self.w + self.b]
        square = [np.zeros_like(v) for v in self.w + self.b]
        step = 0
        for epoch in range(epochs):
            rate = 0.005 * (1 - epoch / epochs)
            for rows in np.array_split(draw.permutation(len(x)), max(1, len(x) // 64)):
                step += 1
                hidden = np.maximum(x[rows] @ self.w[0] + self.b[0], 0)
                wrong = (_softmax(hidden @ self.w[1] + self.b[1]) - answers[rows]) / len(rows)
                back = wrong @ self.w[1].T * (hidden > 0)
                slopes = [x[rows].T @ back, hidden.T @ wrong, back.sum(0), wrong.sum(0)]
                for k, (value, slope) in enumerate(zip(self.w + self.b, slopes, strict=True)):
                    held[k] = 0.9 * held[k] + 0.1 * slope
                    square[k] = 0.999 * square[k] + 0.001 * slope**2
                    value -= rate * (held[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)

    def probabilities(self, vectors: np.ndarray) -> np.ndarray:
        x = np.clip(vectors / self.scale - self.middle / self.scale, -1e9, 1e9)
        hidden = np.maximum(x @ self.w[0] + self.b[0], 0)
        return _softmax(hidden @ self.w[1] + self.b[1])


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(1, keepdims=True))
    return x / x.sum(1, keepdims=True)


def usable(table: DataFrame) -> DataFrame:
    """``vec_id, embedding`` (doubles): vectors with an id, not null or zero, with finite components only."""
    doubles = F.col("embedding").cast("array<double>")
    plain = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return table.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & plain & F.exists(doubles, lambda x: x != 0.0)).select(
        "vec_id", doubles.alias("embedding")
    )


def fit(vectors: DataFrame, sample: int = SAMPLE, parts: int = PARTS, seed: int = 0) -> Router | None:
    """The router, learned on at most ``sample`` different vectors of the most frequent length (of
    equally frequent ones the smallest); none if there are too few for parts."""
    lengths = vectors.groupBy(F.size("embedding").alias("long")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "long").take(1)
    if not lengths:
        return None
    total = lengths[0]["n"]
    drawn = vectors.select("embedding").where(F.size("embedding") == lengths[0]["long"]).where(
        F.pmod(F.xxhash64("embedding", "vec_id"), F.lit(1 << 20)) < (1 << 20) * min(1.0, 2 * sample / max(total, 1))
    )
    rows = drawn.orderBy(F.xxhash64("embedding")).limit(2 * sample).collect()
    if not rows:
        return None
    known = np.unique(np.array([r["embedding"] for r in rows]), axis=0)
    known = known[np.abs(known).max(1) < LARGEST]
    if len(known) > sample:
        known = known[np.sort(np.random.default_rng(seed).choice(len(known), sample, replace=False))]
    if len(known) < 4 * parts:
        return None
    graph = neighbour_graph(known, NEIGHBOURS)
    part = balanced_parts(known, graph, parts, seed)
    answers = np.zeros((len(known), parts))
    for near in [*graph.T, *[np.arange(len(known))] * 3]:
        np.add.at(answers, (np.arange(len(known)), part[near]), 1)
    return Router(known, answers / answers.sum(1, keepdims=True), seed)


def _routed(vectors: DataFrame, router: Router | None, probes: int, mass: float, id_name: str) -> DataFrame:
    """Adds ``part``: the most probable one, or for queries one row for each that it is sent to.

    Vectors of another length than the router's are in a part of their own length.
    """
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, parts = np.arange(len(batch)), np.zeros(len(batch), np.int64)
            if router and len(batch):
                long = np.asarray(pc.list_value_length(batch.column("embedding")))
                fits = np.flatnonzero(long == len(router.middle))
                others = np.flatnonzero(long != len(router.middle))
                column = batch.column("embedding").take(pa.array(fits))
                chance = router.probabilities(column.flatten().to_numpy(zero_copy_only=False).reshape(len(fits), len(router.middle)))
                order = np.argsort(-chance, axis=1)
                before = np.cumsum(np.take_along_axis(chance, order, 1), 1) - np.take_along_axis(chance, order, 1)
                sent = (np.arange(order.shape[1]) < probes) | ((before < mass) & (probes > 1))
                rows, place = np.nonzero(sent)
                parts = np.concatenate([order[rows, place], -1 - long[others].astype(np.int64)])
                rows = np.concatenate([fits[rows], others])
            at = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(at), batch.column("embedding").take(at), pa.array(parts, pa.int64())], names
            )

    names = [id_name, "embedding", "part"]
    return vectors.mapInArrow(run, f"{id_name} {kind}, embedding array<double>, part long")


def distances(rows: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Euclidean distances, also where squares of finite components overflow or vanish."""
    with np.errstate(over="ignore"):
        found = np.sqrt(((rows - vector) ** 2).sum(1))
        odd = np.flatnonzero(~np.isfinite(found) | (found < 1e-140))
        if len(odd):
            half = rows[odd] / 2 - vector / 2
            most = np.abs(half).max(1)
            found[odd] = 2 * (most * np.sqrt(((half / np.where(most > 0, most, 1.0)[:, None]) ** 2).sum(1)))
    return found


def search(
    spark: SparkSession, table: DataFrame, queries: DataFrame, nearest: int = 10, router: Router | None = None,
    probes: int = PROBES, mass: float = MASS, block: int = BLOCK, asks: int = QUERIES,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest vectors found for each query, by Euclidean distance.

    ``table`` and ``queries`` have ``vec_id`` and ``embedding``. Vectors without id, null, zero, or that
    hold null or non-finite components take no part; a query's own id is no candidate. Equal
    distances: smaller id first. Rows that repeat an id and vector count once. Without a router
    (too few vectors for parts) all vectors are one part; with one, those of another length than
    its own are parts by length. Vectors of another length than the query are never near it. Other columns are ignored; empty tables
    give no rows.
    """
    vectors = _routed(usable(table).distinct(), router, 1, 0.0, "vec_id")
    vectors = stored(vectors, "vectors")
    asked = stored(_routed(usable(queries).distinct(), router, probes, mass, "query_id"), "queries")
    # Vectors of a part are compared in blocks, and its queries in shares, so that one that very many
    # are in is dealt over tasks. A row for each part, and for each other length of vectors.
    sizes = vectors.groupBy("part").agg(F.ceil(F.count("*") / block).alias("blocks"))
    shares = asked.groupBy(F.col("part").alias("_part")).agg(F.ceil(F.count("*") / asks).alias("shares"))
    counts = stored(sizes.join(shares, F.col("part") == F.col("_part")).select("_part", "blocks", "shares"), "parts")
    blocks = F.broadcast(counts)

    def each(many: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(many) - 1))

    nobody = F.lit(None).cast(vectors.schema["vec_id"].dataType)
    held = vectors.join(blocks, F.col("part") == F.col("_part")).select(
        "part", F.pmod(F.xxhash64("vec_id", "embedding"), F.col("blocks")).alias("block"), each("shares").alias("share"),
        nobody.alias("query_id"), "vec_id", "embedding",
    )
    sent = asked.join(blocks, F.col("part") == F.col("_part")).select(
        "part", each("blocks").alias("block"), F.pmod(F.xxhash64("query_id", "embedding"), F.col("shares")).alias("share"),
        "query_id", nobody.alias("vec_id"), "embedding",
    )

    def compare(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        found = []
        is_query = frame["vec_id"].isna().to_numpy()
        for long, group in frame.groupby(frame["embedding"].map(len).to_numpy()):
            ask, have = group[is_query[group.index]], group[~is_query[group.index]]
            if not len(ask) or not len(have):
                continue
            base, ids = np.stack(have["embedding"].to_numpy()), have["vec_id"].to_numpy(np.int64)
            names, wanted = ask["query_id"].to_numpy(np.int64), np.stack(ask["embedding"].to_numpy())
            # Squares neither overflow nor vanish: what is compared roughly has components of about one.
            top = max(np.abs(base).max(), np.abs(wanted).max())
            small = base / top
            square = (small**2).sum(1)
            for first in range(0, len(names), 64):
                rows = slice(first, first + 64)
                own = wanted[rows] / top
                rough = square[None] - 2 * own @ small.T
                rough[names[rows][:, None] == ids[None]] = np.inf
                many = min(nearest, len(ids)) - 1
                # Rounding in the product must not lose one: exact distances decide.
                slack = 1e-9 * (square.max() + (own**2).sum(1))
                bound = np.partition(rough, many, axis=1)[:, many] + slack
                for query, vector, row, most in zip(names[rows], wanted[rows], rough, bound, strict=True):
                    keep = np.flatnonzero((row <= most) & (row < np.inf))
                    distance = distances(base[keep], vector)
                    order = np.lexsort((ids[keep], distance))[:nearest]
                    found.append(pd.DataFrame({"query_id": query, "vec_id": ids[keep[order]], "score": distance[order]}))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    kind = vectors.schema["vec_id"].dataType.simpleString()
    found = held.unionByName(sent).groupBy("part", "block", "share").applyInPandas(
        compare, f"query_id {kind}, vec_id {kind}, score double"
    ).distinct()
    place = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= nearest).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )
