"""Quality classifier: a factorisation machine over hashed words, structure
statistics and metadata, scored in linear time by the sum-of-squares identity.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deliverylens.llm.words import spaced_words, utf8

WORD_BITS = 16  # hashed words share 2^16 features
STEPS = 16  # each statistic falls into one of 17 steps
FACTORS = 4
SAMPLE_ROWS = 4000  # labelled documents that the fit sees at most
THRESHOLD = 0.3

_PUNCTUATION = bytes(b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,'-")
_UPPER = bytes(range(0x41, 0x5B))
_DIGITS = bytes(range(0x30, 0x3A))


def structure(data: bytes, n_chars: float | None) -> list[float]:
    """Statistics of a text's bytes and of its row, each between 0 and 1."""
    words = spaced_words(data)
    lines = data.split(b"\n")
    n, size = max(len(words), 1), max(len(data), 1)
    counts = Counter(words)
    share = lambda drop: (len(data) - len(data.translate(None, drop))) / size
    length = 0.0 if n_chars is None or n_chars != n_chars else math.log2(1 + max(n_chars, 0)) / 24
    return [
        len(counts) / n,
        max(counts.values(), default=0) / n,
        sum(map(bytes.__eq__, words, words[1:])) / n,
        1 - len(set(lines)) / len(lines),
        min(1.0, 4 * share(_PUNCTUATION)),
        min(1.0, 4 * share(_DIGITS)),
        share(_UPPER),
        sum(map(len, words)) / n / 24,
        min(1.0, len(lines) / n * 4),
        math.log2(1 + len(words)) / 20,
        length,
    ]


N_STATISTICS = 11
WIDTH = (1 << WORD_BITS) + N_STATISTICS * (STEPS + 1)


def features(text: str | None, n_chars: float | None) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values of one document: its distinct words share a unit
    of length, each statistic lights the step it falls into."""
    data = utf8(text)
    mask = (1 << WORD_BITS) - 1
    hashed = {zlib.crc32(w) & mask for w in set(spaced_words(data))}
    steps = [
        (1 << WORD_BITS) + k * (STEPS + 1) + int(min(max(x, 0.0), 1.0) * STEPS)
        for k, x in enumerate(structure(data, n_chars))
    ]
    index = np.fromiter([*sorted(hashed), *steps], dtype=np.int32, count=len(hashed) + len(steps))
    value = np.full(len(index), 1 / math.sqrt(N_STATISTICS), dtype=np.float32)
    value[: len(hashed)] = 1 / math.sqrt(max(len(hashed), 1))
    return index, value


@dataclass
class FactorisationMachine:
    bias: float
    weights: np.ndarray  # one per feature
    factors: np.ndarray  # a row per feature

    def margin(self, index: np.ndarray, value: np.ndarray) -> float:
        """Pairs cost no more than single features: with s = sum v x and q = sum (v x)^2
        per factor, the sum over pairs is half of s^2 - q."""
        parts = self.factors[index] * value[:, None]
        pairs = 0.5 * float((parts.sum(0) ** 2 - (parts**2).sum(0)).sum())
        return self.bias + float(self.weights[index] @ value) + pairs

    def score(self, index: np.ndarray, value: np.ndarray) -> float:
        return 1 / (1 + math.exp(-min(max(self.margin(index, value), -40.0), 40.0)))


def fit_rows(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = 12, rate: float = 0.1, decay: float = 1e-5):
    """Logistic loss, one row at a time, with a step size per weight (AdaGrad)."""
    rng = np.random.default_rng(42)
    positive = sum(y for *_, y in rows)
    odds = (positive + 1) / (len(rows) - positive + 1)
    machine = FactorisationMachine(
        math.log(odds), np.zeros(WIDTH), rng.normal(0, 0.05, (WIDTH, FACTORS))
    )
    if not 0 < positive < len(rows):
        machine.factors[:] = 0
        return machine
    seen_w, seen_v, seen_b = np.full(WIDTH, 1e-6), np.full((WIDTH, FACTORS), 1e-6), 1e-6
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            index, value, label = rows[k]
            error = machine.score(index, value) - label
            own = machine.factors[index]
            total = (own * value[:, None]).sum(0)
            slope_w = error * value + decay * machine.weights[index]
            slope_v = error * value[:, None] * (total - own * value[:, None]) + decay * own
            seen_w[index] += slope_w**2
            seen_v[index] += slope_v**2
            seen_b += error**2
            machine.weights[index] -= rate * slope_w / np.sqrt(seen_w[index])
            machine.factors[index] -= rate * slope_v / np.sqrt(seen_v[index])
            machine.bias -= rate * error / math.sqrt(seen_b)
    return machine


def held_out(key: Column) -> Column:
    """Whether a document is kept from learning: a fifth by its id, and those without one."""
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(True))


@F.pandas_udf(
    T.StructType(
        [T.StructField("index", T.ArrayType(T.IntegerType())), T.StructField("value", T.ArrayType(T.FloatType()))]
    )
)
def _features(texts: pd.Series, n_chars: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([features(t, n) for t, n in zip(texts, n_chars, strict=True)], columns=["index", "value"])


def fit_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> FactorisationMachine:
    """Fit on at most ``sample_rows`` labelled documents that are not held out, taken
    by a hash of their ids, so that the driver never holds more than that many rows.

    Rows with a null id or label are left out; where labels of a document differ, the
    lower counts. Without labels of both classes the score is one number for all.
    """
    marked = (
        labels.select(F.col("doc_id").alias("id"), F.col("quality").alias("mark"))
        .where(F.col("mark").isNotNull() & ~held_out(F.col("id")))
        .groupBy("id")
        .agg(F.min("mark").alias("mark"))
    )
    texts = docs.select(F.col("doc_id").alias("id"), F.col("text"), _length(docs).alias("length"))
    chosen = (
        marked.join(texts.select("id").where("id is not null").distinct(), "id", "left_semi")
        .orderBy(F.xxhash64("id"), "id")
        .limit(sample_rows)
    )
    rows = (
        texts.join(F.broadcast(chosen), "id")
        .dropDuplicates(["id"])
        .select("id", (F.col("mark") > 0).cast("int").alias("mark"), _features("text", "length").alias("f"))
        .select("id", "mark", "f.index", "f.value")
        .toArrow()
        .sort_by("id")
    )
    return fit_rows(
        [
            (np.asarray(i, dtype=np.int32), np.asarray(v, dtype=np.float32), y)
            for i, v, y in zip(
                rows["index"].to_pylist(), rows["value"].to_pylist(), rows["mark"].to_pylist(), strict=True
            )
        ]
    )


def _length(docs: DataFrame) -> Column:
    return F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")


def quality_score(docs: DataFrame, machine: FactorisationMachine) -> Column:
    """The score of each row of ``docs`` as a column, between 0 and 1."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        model = shared.value
        for texts, lengths in batches:
            yield pd.Series(
                [model.score(*features(t, n)) for t, n in zip(texts, lengths, strict=True)], dtype="float64"
            )

    return score(F.col("text"), _length(docs))


def classify_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``.

    Null texts count as empty ones and get a score like any other text; a null id is
    held out. Repeated rows stay. Only doc_id, text and n_chars (if there) are read,
    the id to tell what is held out; an empty table gives an empty result.
    """
    scored = docs.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        quality_score(docs, fit_quality(docs, labels)).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, columns as they are."""
    accepted: Callable[[], Column] = lambda: quality_score(docs, fit_quality(docs, labels)) >= THRESHOLD
    return docs.where(accepted())
