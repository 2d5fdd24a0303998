"""Toxicity by a chain of linear classifiers.

Categories are predicted one after another; each model sees the words and the probabilities of the
categories before it. So that a later model learns from probabilities as good as it will get, it is
trained on out-of-fold ones: those of models that did not see the row.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartulary.llm.common import documents_of, slices, stored

#: Label columns in the order of the chain.
CATEGORIES = ("quality", "toxic")
#: The training sample: rows of each combination of labels, words, folds.
ROWS_PER_KIND = 800
VOCABULARY = 1000
FOLDS = 5
#: A word is used if the shares of documents with it differ by so many standard errors between classes.
LEAST_ERRORS = 5.5
_WORD = re.compile(r"[^\W\d_]+|[^\w\s]{2,}")


#: Word beginnings of these lengths count, by how many different words have them.
BEGINNINGS = (4, 5, 6, 7)
MOST_COUNTED = 3


def features_of(text: str, beginnings: set[str] | None = None) -> set[str]:
    """What the models see of a whole text: its different words (runs of letters, in lower case, or
    of signs), and the beginnings that one, two, three or more of them share.

    With ``beginnings`` only these are counted.
    """
    words = set(_WORD.findall(text.lower()))
    counts = Counter(
        start for word in words for k in BEGINNINGS if len(word) >= k and (beginnings is None or word[:k] in beginnings)
        for start in (word[:k],)
    )
    return words | {f"{start}^{k}" for start, many in counts.items() for k in range(1, min(many, MOST_COUNTED) + 1)}


class Logistic:
    """Logistic regression with a small ridge, classes weighted alike, by accelerated gradient steps."""

    def __init__(self, rows: np.ndarray, answers: np.ndarray, ridge: float = 1e-3, steps: int = 300) -> None:
        share = answers.mean() if len(answers) else 0.0
        self.weights, self.bias = np.zeros(rows.shape[1], np.float32), 0.0
        if share in (0.0, 1.0):  # one class only: nothing to tell apart
            self.bias = 20.0 if share else -20.0
            return
        emphasis = np.where(answers == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32) / len(answers)
        # The steepest curvature, by power iteration, bounds the step.
        along, along_bias, curve = np.ones(rows.shape[1], np.float32), 1.0, 1.0
        for _ in range(20):
            pushed = (rows @ along + along_bias) * emphasis
            along, along_bias = rows.T @ pushed, float(pushed.sum())
            curve = float(np.sqrt((along**2).sum() + along_bias**2)) + 1e-12
            along, along_bias = along / curve, along_bias / curve
        rate = 1 / (0.3 * curve + ridge)
        ahead, ahead_bias, before, before_bias = self.weights.copy(), 0.0, self.weights, 0.0
        for step in range(steps):
            wrong = (_sigmoid(rows @ ahead + ahead_bias) - answers) * emphasis
            self.weights = ahead - rate * (rows.T @ wrong + ridge * ahead)
            self.bias = ahead_bias - rate * float(wrong.sum())
            pace = step / (step + 3)
            ahead, ahead_bias = self.weights + pace * (self.weights - before), self.bias + pace * (self.bias - before_bias)
            before, before_bias = self.weights, self.bias

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        return _sigmoid(rows @ self.weights + self.bias)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return (1 / (1 + np.exp(-np.clip(x, -30, 30)))).astype(np.float32)


@dataclass
class Chain:
    """A model for each category; its inputs are the words and the earlier categories."""

    vocabulary: dict[str, int]
    models: list[Logistic] = field(default_factory=list)
    thresholds: list[float] = field(default_factory=list)

    def train(self, rows: np.ndarray, labels: np.ndarray, folds: np.ndarray) -> Chain:
        """``labels`` has a column for each category; ``folds`` the fold of each row."""
        known = rows
        for category in range(labels.shape[1]):
            answers = labels[:, category].astype(np.float32)
            outside = np.zeros(len(answers), np.float32)
            for fold in range(FOLDS):
                own = folds == fold
                if own.any():
                    outside[own] = Logistic(known[~own], answers[~own]).probabilities(known[own])
            self.models.append(Logistic(known, answers))
            self.thresholds.append(best_threshold(outside, answers))
            known = np.concatenate([known, outside[:, None]], 1)
        return self

    def probabilities(self, found: list[list[int]]) -> np.ndarray:
        """A row of probabilities for each text's vocabulary words."""
        rows = np.zeros((len(found), len(self.vocabulary)), np.float32)
        at = np.repeat(np.arange(len(found)), [len(x) for x in found])
        rows[at, np.fromiter((k for x in found for k in x), np.int64, len(at))] = 1
        for model in self.models:
            rows = np.concatenate([rows, model.probabilities(rows)[:, None]], 1)
        return rows[:, len(self.vocabulary) :]


def best_threshold(scores: np.ndarray, answers: np.ndarray) -> float:
    """The threshold with the best F1, in the middle between two scores; 0.5 if no class is apart."""
    if not 0 < answers.sum() < len(answers):
        return 0.5
    order = np.argsort(-scores)
    hits = np.cumsum(answers[order])
    f1 = 2 * hits / (np.arange(1, len(order) + 1) + answers.sum())
    last = np.append(scores[order][1:] < scores[order][:-1], True)
    best = int(np.argmax(np.where(last, f1, 0)))
    after = scores[order][best + 1] if best + 1 < len(order) else 0.0
    return float((scores[order][best] + after) / 2)


def fit(documents: DataFrame, labels: DataFrame, categories: tuple[str, ...] = CATEGORIES) -> Chain | None:
    """The chain, from at most ``ROWS_PER_KIND`` labelled documents of each combination of labels.

    Rows with a null label, or without text, teach nothing. None if there are none left.
    """
    kinds = [F.col(c).cast("int") for c in categories]
    marked = labels.select("doc_id", *[k.alias(c) for k, c in zip(kinds, categories, strict=True)]).dropna()
    counts = marked.groupBy(*categories).agg(F.count("*").alias("n")).collect()  # at most 2 ** categories rows
    if not counts:
        return None
    share = F.lit(0.0)
    for row in counts:
        own = F.lit(True)
        for c in categories:
            own = own & (F.col(c) == row[c])
        share = F.when(own, min(1.0, ROWS_PER_KIND / row["n"])).otherwise(share)
    draw: Column = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    # About the bound's number of rows, whatever the size of the tables.
    drawn = marked.where(draw < share * (1 << 20)).withColumnRenamed("doc_id", "_doc")
    sample = documents.join(F.broadcast(drawn), F.col("doc_id") == F.col("_doc")).select(
        F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(FOLDS)).alias("fold"), "text", *categories
    )

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [sorted(features_of(x)) for x in batch.column("text").to_pylist()]
            columns = [batch.column(c) for c in ("fold", *categories)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(words, pa.list_(pa.string()))], ["fold", *categories, "words"])

    schema = "fold long, " + "".join(f"{c} int, " for c in categories) + "words array<string>"
    sample = stored(sample.mapInArrow(split, schema), "sample")
    total = sample.agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in categories]).first()
    if not total["n"]:
        return None
    # Words that tell a category apart for certain: rare words that chance gave to one class do not.
    each = sample.select(F.explode("words").alias("word"), *categories).groupBy("word").agg(
        F.count("*").alias("n"), *[F.sum(c).alias(c) for c in categories]
    ).where("n > 2")
    gap = F.lit(0.0)
    for c in categories:
        yes, no = max(total[c], 1), max(total["n"] - total[c], 1)
        share = F.col("n") / total["n"]
        error = F.sqrt(F.greatest(share * (1 - share), F.lit(1e-9)) * (1 / yes + 1 / no))
        gap = F.greatest(gap, F.abs(F.col(c) / yes - (F.col("n") - F.col(c)) / no) / error)
    chosen = [
        r["word"] for r in each.withColumn("gap", gap).where(F.col("gap") >= LEAST_ERRORS).orderBy(F.desc("gap"), "word").limit(VOCABULARY).collect()
    ]
    vocabulary = {word: k for k, word in enumerate(sorted(chosen))}
    known = F.array(*[F.lit(w) for w in sorted(chosen)]) if chosen else F.array().cast("array<string>")
    rows = sample.select("fold", *categories, F.array_intersect("words", known).alias("words")).collect()
    rows.sort(key=lambda r: (r["fold"], r["words"], *[r[c] for c in categories]))
    matrix = np.zeros((len(rows), len(vocabulary)), np.float32)
    for k, row in enumerate(rows):
        matrix[k, [vocabulary[w] for w in row["words"]]] = 1
    answers = np.array([[r[c] for c in categories] for r in rows])
    return Chain(vocabulary).train(matrix, answers, np.array([r["fold"] for r in rows]))


def classify(table: DataFrame, labels: DataFrame, categories: tuple[str, ...] = CATEGORIES) -> DataFrame:
    """``doc_id``, a score for each category (``<category>_score``) and the last one's decision.

    ``table(doc_id, text)`` and ``labels(doc_id, <category>, ...)`` with 0 or 1. Whole texts are
    judged; null or empty text has no words, and then, as without any labelled rows, the scores are
    0 and the decision is false. Rows that share an id are judged each for itself, and teach as
    often; null ids are kept. Other columns are ignored; an empty table gives no rows.
    """
    documents = documents_of(table)
    chain = fit(documents, labels, categories)
    names = ["doc_id", *[f"{c}_score" for c in categories], categories[-1]]
    schema = T.StructType(
        [documents.schema["doc_id"], *[T.StructField(n, T.DoubleType()) for n in names[1:-1]], T.StructField(names[-1], T.BooleanType())]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = {x.partition("^")[0] for x in chain.vocabulary if "^" in x[1:]} if chain else set()
        for batch in batches:
            for first, last in slices(batch, "text", 1 << 20):
                part = batch.slice(first, last - first)
                words = [features_of(x, starts) for x in part.column("text").to_pylist()]
                scores = np.zeros((len(part), len(categories)))
                decided = np.zeros(len(part), bool)
                if chain:
                    keys, get = chain.vocabulary.keys(), chain.vocabulary.__getitem__
                    scores = chain.probabilities([[get(w) for w in keys & x] for x in words]).astype(np.float64)
                    scores[[not x for x in words]] = 0
                    decided = scores[:, -1] >= chain.thresholds[-1]
                    decided[[not x for x in words]] = False
                columns = [pa.array(scores[:, k]) for k in range(len(categories))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns, pa.array(decided)], names)

    return documents.mapInArrow(run, schema)
