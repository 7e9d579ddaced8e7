"""Quality grades by ordinal regression (cumulative links) on hashed text.

All grades share one weight a feature; ordered thresholds cut the score: P(grade <= j) is
sigmoid(threshold_j - score). Features are the distinct words of a text, lower-cased, and the distinct
shapes of its words (runs of small letters, capitals and digits each made one sign), both hashed.
From the grade probabilities come the expected grade and the probability of a grade or a better one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import SPACE_BYTES
from millrace.llm.words import _BASE, _BYTE, Texts, mix, powers, slices, sums, word_table

_TABLE = word_table(SPACE_BYTES)
_SIGN = np.arange(256, dtype=np.uint8)
_SIGN[ord("a") : ord("z") + 1] = ord("a")
_SIGN[ord("A") : ord("Z") + 1] = ord("A")
_SIGN[ord("0") : ord("9") + 1] = ord("9")
_SIGN[0x80:] = ord("a")
#: What surrounds a word and is not part of it for the word feature.
_PLAIN = word_table(bytes(b for b in range(0x80) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122)))


def features(column: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature) of all distinct features of all texts, sorted by text."""
    low = Texts(column, _PLAIN, lower=True)
    shape = Texts(column, _TABLE)
    signs = _SIGN[shape.buf]
    inside = _TABLE[shape.buf]
    first = np.zeros(len(signs) + 1, bool)
    first[shape.starts] = True
    kept = inside & (first[:-1] | np.r_[True, signs[1:] != signs[:-1]][: len(signs)])
    place = np.r_[0, np.cumsum(kept)]
    short = signs[kept]
    p = sums(_BYTE[short] * powers(_BASE, len(short)))
    inverse = powers(pow(_BASE, -1, 1 << 64), len(short) + 1)
    s, e = place[shape.starts], place[shape.ends]
    shapes = mix((p[e] - p[s]) * inverse[s], 11)
    doc = np.r_[low.doc_of_word(), shape.doc_of_word()].astype(np.int64)
    hashes = np.r_[low.word_hashes(), shapes]
    both = np.unique(doc << bits | (hashes >> np.uint64(64 - bits)).astype(np.int64))
    return both >> bits, both & ((1 << bits) - 1)


@dataclass
class CumulativeLink:
    """weights: one a hashed feature; thresholds: ascending, one less than there are grades; grades: their values."""

    weights: np.ndarray
    thresholds: np.ndarray
    grades: list[float]

    @property
    def bits(self) -> int:
        return len(self.weights).bit_length() - 1

    def at_most(self, score: np.ndarray) -> np.ndarray:
        """P(grade <= j) for each score and all grades but the best."""
        return 1 / (1 + np.exp(np.clip(score[:, None] - self.thresholds[None, :], -500, 500)))

    def judge(self, score: np.ndarray, tail: int) -> tuple[np.ndarray, np.ndarray]:
        """(expected grade, probability of grade number ``tail`` or a better one)."""
        c = np.column_stack([np.zeros(len(score)), self.at_most(score), np.ones(len(score))])
        return np.diff(c, axis=1) @ np.array(self.grades), 1 - c[:, tail]

    @classmethod
    def fit(cls, texts: list[np.ndarray], y: np.ndarray, grades: list[float], bits: int, rounds: int = 150, rate: float = 0.3, sparsity: float = 0.002, least: int = 5) -> CumulativeLink:
        """By full-batch AdaGrad from zero weights; the same rows give the same model.

        Only features of ``least`` texts or more count, and a weight stays zero unless its mean gradient
        passes ``sparsity``, so that words met by chance have no say.
        """
        k = len(grades)
        weights = np.zeros(1 << bits)
        share = np.cumsum(np.bincount(y, minlength=k)[: k - 1]) / max(len(y), 1)
        thresholds = np.log(np.clip(share, 1e-3, 1 - 1e-3) / (1 - np.clip(share, 1e-3, 1 - 1e-3)))
        thresholds += np.arange(k - 1) * 1e-6
        if k < 2:
            return cls(weights, thresholds, grades)
        rows = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        cols = np.concatenate(texts)
        often = np.bincount(cols, minlength=1 << bits) >= least
        rows, cols = rows[often[cols]], cols[often[cols]]
        past, past_t = np.full(1 << bits, 1e-6), np.full(k - 1, 1e-6)
        edges = lambda: np.r_[-np.inf, thresholds, np.inf]
        for _ in range(rounds):
            score = np.bincount(rows, weights[cols], minlength=len(texts))
            t = edges()
            a = 1 / (1 + np.exp(np.clip(score - t[y + 1], -500, 500)))
            b = 1 / (1 + np.exp(np.clip(score - t[y], -500, 500)))
            p = np.maximum(a - b, 1e-12)
            g = np.bincount(cols, (a + b - 1)[rows], minlength=1 << bits) / len(texts)
            gt = (np.bincount(y, a * (1 - a) / p, minlength=k)[: k - 1] - np.bincount(y, b * (1 - b) / p, minlength=k)[1:]) / len(texts)
            past += g * g
            past_t += gt * gt
            weights += rate * g / np.sqrt(past)
            weights = np.sign(weights) * np.maximum(np.abs(weights) - rate * sparsity / np.sqrt(past), 0)
            thresholds = np.sort(thresholds + rate * gt / np.sqrt(past_t))
        return cls(weights, thresholds, grades)


def fit(docs: DataFrame, ratings: DataFrame, grade: str = "grade", bits: int = 18, most: int = 8000, text: str = "text", key: str = "doc_id") -> CumulativeLink:
    """Learn from ``most`` rated texts (all, if there are fewer), those whose keys' hashes are least.

    ``ratings`` has (key, grade); of several ratings of a key the least counts. The chosen keys, which are broadcast, and the
    features that come to the driver are at most ``most`` rows each, also where many rows share a key. Null keys, grades and
    texts are left out. Fewer than two grades give a model that knows only the grade there is.
    """
    known = ratings.select(F.col(key).alias("key"), F.col(grade).cast("double").alias("grade")).where("key is not null and grade is not null")
    sample = known.groupBy("key").agg(F.min("grade").alias("grade")).orderBy(F.xxhash64("key"), "key").limit(most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to in slices(batch.column(1)):
                b = batch.slice(at, to - at)
                doc, f = features(b.column(1), bits)
                cut = np.searchsorted(doc, np.arange(len(b) + 1))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(f, pa.int32())), b.column(2)], names=["grade", "f", "key"])

    texts = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"))
    rows = texts.join(F.broadcast(sample), "key").select("grade", "text", F.xxhash64("key").alias("key"))
    found = rows.mapInArrow(run, "grade double, f array<int>, key long").orderBy("key", "grade", "f").limit(most)
    got = sorted(found.collect(), key=lambda r: (r.key, r.grade, r.f))
    grades = sorted({r.grade for r in got})
    place = {g: i for i, g in enumerate(grades)}
    return CumulativeLink.fit([np.array(r.f, np.int64) for r in got], np.array([place[r.grade] for r in got], np.int64), grades or [0.0], bits)


def grade_documents(docs: DataFrame, model: CumulativeLink, tail: float, threshold: float = 0.5, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, expected_grade, tail_probability, keep) of every row.

    tail_probability is that of the grade ``tail`` or a better one, and keep whether it reaches
    ``threshold``. A null or empty text has no features: its score is 0, and it is judged by the thresholds
    alone. Whole texts count; other columns are not read.
    """
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()
    shared = spark.sparkContext.broadcast((model.weights.astype(np.float32), model.thresholds, model.grades))
    number = sum(g < tail for g in model.grades)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = CumulativeLink(*shared.value)
        for batch in batches:
            for at, to in slices(batch.column(1)):
                b = batch.slice(at, to - at)
                doc, f = features(b.column(1), m.bits)
                score = np.bincount(doc, m.weights[f], minlength=len(b))
                expected, p = m.judge(score, number)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(expected), pa.array(p), pa.array(p >= threshold)], names=["key", "expected_grade", "tail_probability", "keep"])

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, expected_grade double, tail_probability double, keep boolean").withColumnRenamed("key", key)
