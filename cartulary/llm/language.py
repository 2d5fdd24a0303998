"""Language identification by a small convolutional network over bytes, trained in numpy.

Every window of a text's bytes goes through filters of several widths, each filter's largest
response in the window is kept, and a softmax over these gives the languages' probabilities. A
text's probabilities are its windows' average, weighted by their bytes.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from cartulary.llm.common import documents_of, lean, restored, slices

UNKNOWN = "und"
WINDOW = 256
#: The training sample: documents of a language at most and at least, of all (if that leaves the least), windows of a document.
DOCUMENTS_PER_LANGUAGE = 300
FEWEST_DOCUMENTS = 8
DOCUMENTS = 19_200
WINDOWS_PER_DOCUMENT = 6
_SYMBOLS = 64
_GAP = 8
#: Windows by languages that are held at once.
_CELLS = 1 << 20


def _symbols() -> np.ndarray:
    """The network's input symbol for each byte: letters without case, digits, space, marks, bytes from 128 on."""
    found = np.empty(256, np.uint8)
    for byte in range(256):
        if chr(byte | 32) in "abcdefghijklmnopqrstuvwxyz":
            found[byte] = 1 + (byte | 32) - 97
        elif byte >= 128:
            found[byte] = 30 + byte % 34
        else:
            found[byte] = 27 if 48 <= byte < 58 else 0 if byte <= 32 else 28 if chr(byte) in ".,;:!?'-" else 29
    return found


SYMBOL = _symbols()


@dataclass
class ByteNetwork:
    """Embedding, filters of several widths, max pooling, softmax."""

    languages: list[str]
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 10
    dimensions: int = 8
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    def start(self, seed: int) -> None:
        draw = np.random.default_rng(seed)
        self.weights = {"e": draw.normal(0, 0.5, (_SYMBOLS, self.dimensions))}
        for w in self.widths:
            self.weights[f"f{w}"] = draw.normal(0, (w * self.dimensions) ** -0.5, (w * self.dimensions, self.filters))
            self.weights[f"b{w}"] = np.zeros(self.filters)
        self.weights["o"] = draw.normal(0, 0.1, (len(self.widths) * self.filters, len(self.languages)))
        self.weights["c"] = np.zeros(len(self.languages))

    def train(self, symbols: np.ndarray, answers: np.ndarray, steps: int = 500, batch: int = 48, seed: int = 0) -> None:
        """Adam on the cross-entropy of windows (rows of ``symbols``, followed by the gap)."""
        self.start(seed)
        draw = np.random.default_rng(seed + 1)
        mean = {k: np.zeros_like(v) for k, v in self.weights.items()}
        square = {k: np.zeros_like(v) for k, v in self.weights.items()}
        for step in range(1, steps + 1):
            pick = draw.integers(0, len(answers), batch)
            slope = self._slope(symbols[pick], answers[pick])
            rate = 0.01 * min(1.0, 2 * (1 - (step - 1) / steps))
            for k, g in slope.items():
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.99 * square[k] + 0.01 * g * g
                self.weights[k] -= rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)

    def _slope(self, symbols: np.ndarray, answers: np.ndarray) -> dict[str, np.ndarray]:
        many, long = symbols.shape
        vectors = self.weights["e"][symbols]
        pooled, places = [], []
        for w in self.widths:
            view = np.concatenate([vectors[:, k : long - _GAP + k] for k in range(w)], 2)
            response = view @ self.weights[f"f{w}"]
            place = response.argmax(1)
            places.append(place)
            pooled.append(np.take_along_axis(response, place[:, None], 1)[:, 0] + self.weights[f"b{w}"])
        raw = np.concatenate(pooled, 1)
        hidden = np.maximum(raw, 0)
        wrong = _softmax(hidden @ self.weights["o"] + self.weights["c"])
        wrong[np.arange(many), answers] -= 1
        wrong /= many
        slope = {"o": hidden.T @ wrong, "c": wrong.sum(0), "e": np.zeros_like(self.weights["e"])}
        back = (wrong @ self.weights["o"].T) * (raw > 0)
        for n, w in enumerate(self.widths):
            own, place = back[:, n * self.filters : (n + 1) * self.filters], places[n]
            slope[f"b{w}"] = own.sum(0)
            at = place[:, :, None] + np.arange(w)  # only the largest response's bytes get a slope
            seen = symbols[np.arange(many)[:, None, None], at]
            part = self.weights["e"][seen].reshape(many, self.filters, -1)
            slope[f"f{w}"] = np.einsum("mf,mfd->df", own, part)
            kernel = self.weights[f"f{w}"].T.reshape(self.filters, w, self.dimensions)
            np.add.at(slope["e"], seen.ravel(), (own[:, :, None, None] * kernel).reshape(-1, self.dimensions))
        return slope

    def tables(self) -> list[tuple[int, list[np.ndarray]]]:
        """Each filter as sums of table look-ups, one for each two bytes: what inference needs."""
        found = []
        for w in self.widths:
            kernel = self.weights[f"f{w}"].reshape(w, self.dimensions, self.filters)
            single = np.einsum("sd,wdf->wsf", self.weights["e"], kernel).astype(np.float32)
            for f in range(self.filters):
                looked = [
                    (single[k, :, f][:, None] + single[k + 1, :, f][None]).ravel() if k + 1 < w
                    else np.repeat(single[k, :, f], _SYMBOLS)
                    for k in range(0, w, 2)
                ]
                looked[0] = looked[0] + np.float32(self.weights[f"b{w}"][f])
                found.append((w, looked))
        return found


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(1, keepdims=True))
    return x / x.sum(1, keepdims=True)


def windows(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of texts laid out in whole windows, blank between texts, and each text's windows."""
    counts = np.array([(len(x) + 3) // WINDOW + 1 for x in raw], np.int64)
    laid = np.zeros(counts.sum() * WINDOW + _GAP, np.uint8)
    for start, x in zip(((np.cumsum(counts) - counts) * WINDOW).tolist(), raw, strict=True):
        laid[start : start + len(x)] = np.frombuffer(x, np.uint8)
    return SYMBOL[laid], counts


def probabilities(network: ByteNetwork, tables: list[tuple[int, list[np.ndarray]]], raw: list[bytes]) -> np.ndarray:
    """The languages' probabilities for each whole text."""
    if not raw:
        return np.zeros((0, len(network.languages)))
    symbols, counts = windows(raw)
    pair = symbols[:-1].astype(np.int32) * _SYMBOLS + symbols[1:]
    total = int(counts.sum()) * WINDOW
    hidden = np.empty((len(tables), total // WINDOW), np.float32)
    for k, (_, looked) in enumerate(tables):
        response = looked[0].take(pair[:total])
        for n, table in enumerate(looked[1:], 1):
            response += table.take(pair[2 * n : 2 * n + total])
        hidden[k] = response.reshape(-1, WINDOW).max(1)
    first = np.cumsum(counts) - counts
    held = np.full(int(counts.sum()), WINDOW, np.float64)
    held[first + counts - 1] = np.array([len(x) for x in raw]) - (counts - 1) * WINDOW
    held = np.maximum(held, 1e-3)
    owner = np.repeat(np.arange(len(raw)), counts)
    total = np.zeros((len(raw), len(network.languages)))
    step = max(1, _CELLS // len(network.languages))
    for at in range(0, len(held), step):  # so many windows at once that all languages fit
        part = slice(at, at + step)
        found = _softmax(np.maximum(hidden[:, part].T, 0) @ network.weights["o"] + network.weights["c"])
        texts, starts = np.unique(owner[part], return_index=True)
        total[texts] += np.add.reduceat(found * held[part, None], starts)
    return total / np.add.reduceat(held, first)[:, None]


def held_out(id_column: Column) -> Column:
    """A quarter of the documents, by checksum of the id; those without an id are not in it."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_sample(labelled: DataFrame) -> list[tuple[str, bytes]]:
    """The bounded sample of ``labelled(_row, text, lang)``: windows with their languages, all of them.

    The more languages there are, the fewer documents are of each, but some always are.
    """
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return []
    each = min(DOCUMENTS_PER_LANGUAGE, max(FEWEST_DOCUMENTS, DOCUMENTS // len(counts)))
    # The share of a language's documents that a hash picks is twice as many, and all of a few.
    shares = labelled.sparkSession.createDataFrame(
        [(k, min(1.0, max(2 * each, 100) / n)) for k, n in sorted(counts.items())], "_lang string, _share double"
    )
    drawn = labelled.join(F.broadcast(shares), F.col("lang") == F.col("_lang")).where(
        F.pmod(F.xxhash64("_row", F.lit(5)), F.lit(1 << 20)) < F.col("_share") * (1 << 20)
    ).drop("_lang", "_share")
    drawn = drawn.withColumn("_n", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("_row", F.lit(6)), "_row")))
    # Windows at even distances over the whole text.
    last = F.greatest(F.length("text") - WINDOW, F.lit(0))
    cut = F.transform(
        F.sequence(F.lit(0), F.lit(WINDOWS_PER_DOCUMENT - 1)),
        lambda k: F.substring(F.col("text"), (last * k / (WINDOWS_PER_DOCUMENT - 1)).cast("int") + 1, F.lit(WINDOW)),
    )
    drawn = drawn.where(F.col("_n") <= each).select("lang", F.explode(F.array_distinct(cut)).alias("text"))
    return sorted((r["lang"], r["text"].encode()[:WINDOW]) for r in drawn.collect())


def fit(sample: list[tuple[str, bytes]], seed: int = 0) -> ByteNetwork:
    """The network for a sample; some windows are shortened, so that short texts are known too."""
    by_language: dict[str, list[bytes]] = {}
    for lang, x in sample:
        by_language.setdefault(lang, []).append(x)
    many = len(by_language)
    network = ByteNetwork(sorted(by_language), filters=max(10, math.ceil(1.25 * many**0.5)))  # 10 for 64 languages
    if many < 2:
        return network
    draw = np.random.default_rng(seed)
    most = max(map(len, by_language.values()))
    rows, answers = [], []
    for n, lang in enumerate(network.languages):
        for k in range(most):  # languages count alike
            own = by_language[lang][k % len(by_language[lang])]
            keep = int(draw.integers(6, WINDOW + 1)) if k % 2 else WINDOW
            start = int(draw.integers(0, max(1, len(own) - keep + 1)))
            rows.append(own[start : start + keep].ljust(WINDOW + _GAP, b" "))
            answers.append(n)
    symbols = SYMBOL[np.frombuffer(b"".join(rows), np.uint8)].reshape(len(rows), -1)
    network.train(symbols, np.array(answers), steps=max(500, 8 * many), seed=seed)
    return network


def identify(table: DataFrame) -> DataFrame:
    """``doc_id, text, _row, lang_pred, score, held_out`` for each row of ``table(doc_id, text, lang)``.

    Learns from rows with text and language that are not held out, at most the bounded sample.
    Null text, or one without a letter (empty too): ``und``, score 0, and so is everything if no
    row is labelled; with one language only, it is predicted with score 1. Rows with equal ids are
    predicted each for itself. Other columns are ignored; an empty table gives no rows.
    """
    has_text = F.col("text").isNotNull()
    return _learned(table, documents_of(table)).withColumn("held_out", held_out(F.col("doc_id")))


def keep_known(table: DataFrame, least_score: float = 0.5) -> DataFrame:
    """The rows of ``table`` whose language is recognised with at least this score, all columns kept."""
    found = _learned(table, documents_of(table, carry=True))
    return restored(found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score)), table.columns)


def _learned(table: DataFrame, documents: DataFrame) -> DataFrame:
    has_text = F.col("text").isNotNull()
    sample = training_sample(
        table.where(has_text & F.col("text").rlike(r"\p{L}") & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))).select(
            F.xxhash64("doc_id", "text").alias("_row"), "text", F.col("lang").cast("string").alias("lang")
        )
    )
    return predict(documents, fit(sample))


def predict(documents: DataFrame, network: ByteNetwork) -> DataFrame:
    """Adds ``lang_pred`` and ``score`` to ``documents`` with ``text``; other columns pass."""
    documents = documents.withColumn("_letters", F.col("text").rlike(r"\p{L}"))
    fields = documents.drop("_letters").schema
    schema = T.StructType([*fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    names = np.array([*network.languages, UNKNOWN], object)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = network.tables() if len(network.languages) > 1 else []
        for batch in batches:
            for first, last in slices(batch, "text", 1 << 19):
                part = batch.slice(first, last - first)
                letters = np.asarray(part.column("_letters").to_pylist(), bool)
                best = np.full(len(part), len(network.languages))
                score = np.zeros(len(part))
                if letters.any() and network.languages:
                    if tables:
                        raw = [x.as_py().encode("utf-8", "surrogatepass") for x in part.column("text").filter(pa.array(letters))]
                        found = probabilities(network, tables, raw)
                    else:
                        found = np.ones((int(letters.sum()), 1))
                    best[letters], score[letters] = found.argmax(1), np.clip(found.max(1), 0, 1)
                columns = [part.column(name) for name in fields.names]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(names[best].tolist(), pa.string()), pa.array(score)], [*fields.names, "lang_pred", "score"]
                )

    return documents.mapInArrow(lean(run), schema)
