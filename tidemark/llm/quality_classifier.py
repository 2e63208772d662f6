"""A quality classifier for graded ratings: cumulative-link (ordinal logistic) regression.

One set of weights over hashed text features serves all grades; ordered thresholds t_1 <=
t_2 ... cut its output: P(grade >= j) = sigmoid(w . x - t_j).  Thresholds are kept ordered
by learning the first and the logarithms of the steps.  Selection uses the expected grade
and the tail probability P(grade >= the best but ``floor``).

Features are the hashed character 1- to 4-grams of the words, signs included, averaged over
the text, and the share of words equal to the word before.  Like the toxicity model, scoring
is a sum of one number per n-gram: one pass over whole texts without a shuffle.

Training takes at most ``per_grade`` rated texts of each grade, those whose ids hash lowest,
and weighs grades alike.  Edge cases: ids may have any type; a text without words (null, empty, white space) has expected grade
0 and tail probability 0; ids rated more than once count with their lowest grade; null
grades are left out; with fewer than two grades all texts get the rated grade; repeated rows
each get a row; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.shared import bounded_batches, col, cut
from tidemark.llm.subwords import frequent, ngrams, text_sums
from tidemark.llm.words import Words, coded, slices

SIZES = (1, 2, 3, 4)
BITS = 18
PER_GRADE = 800
STEPS = 150
RATE = 0.05
PENALTY = 1e-4
REPEAT_SCALE = 10.0
#: n-grams in fewer training texts are left out.
LEAST_TEXTS = 5


def _repeats(words: Words) -> np.ndarray:
    """The share of a text's words that equal the word before, times REPEAT_SCALE."""
    same = np.zeros(len(words.codes) + 1)
    same[1:-1] = words.codes[1:] == words.codes[:-1] if len(words.codes) else 0
    inner = words.starts[:-1][words.starts[:-1] < len(words.codes)]
    same[inner] = 0  # the first word of a text has none before
    upto = np.concatenate([[0.0], np.cumsum(same[: len(words.codes)])])
    return REPEAT_SCALE * (upto[words.starts[1:]] - upto[words.starts[:-1]]) / np.maximum(np.diff(words.starts), 1)


@dataclass
class Model:
    weights: np.ndarray
    repeat: float
    thresholds: np.ndarray
    grades: np.ndarray

    def tails(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """P(grade >= grades[j]) for j = 1, 2 ..., one column each, 0 for texts without words; and which texts have words."""
        words = coded(texts)
        bucket, owner = ngrams(words.vocabulary, SIZES, BITS, marks=True)
        size = len(words.vocabulary)
        total = text_sums(words, np.bincount(owner, self.weights[bucket], size))
        count = text_sums(words, np.bincount(owner, minlength=size).astype(float))
        z = total / np.maximum(count, 1) + self.repeat * _repeats(words)
        out = 1 / (1 + np.exp(-np.clip(z[:, None] - self.thresholds[None, :], -50, 50)))
        some = np.diff(words.starts) > 0
        return np.where(some[:, None], out, 0.0), some


def train(texts: pa.Array, grade: np.ndarray) -> Model:
    """Fit weights and thresholds by full-batch Adam on the weighted negative log likelihood."""
    grades = np.unique(grade)
    if len(grades) < 2:
        return Model(np.zeros(1 << BITS, np.float32), 0.0, np.zeros(0), grades if len(grades) else np.zeros(1, np.int64))
    words = coded(texts)
    size, rows, levels = len(words.vocabulary), len(grade), len(grades)
    row = np.repeat(np.arange(rows), np.diff(words.starts))
    pairs, times = np.unique(row * size + words.codes, return_counts=True)
    row, code = pairs // size, pairs % size
    names, at, owner, grams = frequent(words.vocabulary, np.bincount(code, minlength=size), LEAST_TEXTS, SIZES, BITS, marks=True)
    part, repeats = times / np.maximum(np.bincount(row, times * grams[code], rows), 1)[row], _repeats(words)
    own = np.searchsorted(grades, grade)
    weight = 1 / np.bincount(own)[own] / levels
    # Averages are small numbers: features are scaled by the root of their mean share, so that all learn alike.
    share = np.bincount(at, np.bincount(code, part, size)[owner], len(names)) / rows
    scale = 1 / np.sqrt(share + 1e-6)
    params = {"w": np.zeros(len(names)), "r": np.zeros(1), "t": np.concatenate([[0.0], np.zeros(levels - 2)])}
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in params.items()}
    sigmoid = lambda v: 1 / (1 + np.exp(-np.clip(v, -50, 50)))
    for step in range(1, STEPS + 1):
        w, t = params["w"], params["t"]
        thresholds = t[0] + np.concatenate([[0.0], np.cumsum(np.exp(t[1:]))])
        z = np.bincount(row, part * np.bincount(owner, (w * scale)[at], size)[code], rows) + params["r"] * repeats
        tail = np.concatenate([np.ones((rows, 1)), sigmoid(z[:, None] - thresholds), np.zeros((rows, 1))], 1)
        slope = tail * (1 - tail)
        i = np.arange(rows)
        p = np.maximum(tail[i, own] - tail[i, own + 1], 1e-9)
        dz = -weight * (slope[i, own] - slope[i, own + 1]) / p
        dcut = np.zeros(levels + 1)
        np.add.at(dcut, own, weight * slope[i, own] / p)
        np.add.at(dcut, own + 1, -weight * slope[i, own + 1] / p)
        dcut = dcut[1:-1]
        grads = {
            "w": np.bincount(at, np.bincount(code, part * dz[row], size)[owner], len(names)) * scale + PENALTY * w,
            "r": np.array([(dz * repeats).sum()]) + PENALTY * params["r"],
            "t": np.concatenate([[dcut.sum()], np.cumsum(dcut[::-1])[::-1][1:] * np.exp(t[1:])]),
        }
        for k, g in grads.items():
            m, v = moments[k]
            m += 0.1 * (g - m)
            v += 0.001 * (((g * g).mean() if k == "w" else g * g) - v)
            params[k] -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-10)
    weights = np.zeros(1 << BITS, np.float32)
    weights[names] = params["w"] * scale
    t = params["t"]
    return Model(weights, float(params["r"][0]), t[0] + np.concatenate([[0.0], np.cumsum(np.exp(t[1:]))]), grades)


def rate(docs: DataFrame, rated: DataFrame, grade: Column, id_col: str = "doc_id", text_col: str = "text", per_grade: int = PER_GRADE, floor: int = 0) -> DataFrame:
    """One row per text: id, expected_grade, tail_probability and kept (tail probability of 0.5 or more).

    ``grade`` is an integer column expression over ``rated``; the tail begins ``floor`` grades
    below the best (but above the worst).
    """
    narrow = bounded_batches(docs).select(col(id_col).alias("id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    known = rated.select(col(id_col).alias("id"), grade.cast("int").alias("y")).where("id is not null and y is not null")
    known = cut(known.groupBy("id").agg(F.min("y").alias("y")))
    grades = sorted(r.y for r in known.select("y").distinct().collect())  # a rating scale: a handful
    picked = None
    for g in grades:
        one = known.where(F.col("y") == g).orderBy(F.xxhash64("id"), "id").limit(per_grade)
        picked = one if picked is None else picked.union(one)
    picked = cut(picked if picked is not None else known)
    data = narrow.join(F.broadcast(picked), "id").select("id", "text", "y").toArrow().sort_by("id")  # bounded by per_grade
    made = train(data.column("text").combine_chunks(), data.column("y").to_numpy())
    learned = narrow.sparkSession.sparkContext.broadcast((made.weights, made.repeat, made.thresholds, made.grades))  # plain values: workers need no copy of this package

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*learned.value)
        for batch in slices(batches):
            tails, some = m.tails(batch.column("text"))
            steps = np.diff(m.grades).astype(float)
            expected = np.where(some, m.grades[0] + tails @ steps, 0.0) if len(steps) else np.where(some, float(m.grades[0]), 0.0)
            tail = tails[:, max(0, tails.shape[1] - 1 - floor)] if len(steps) else some.astype(float)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(expected), pa.array(tail)], ["id", "expected_grade", "tail_probability"])

    schema = T.StructType([narrow.schema["id"], *[T.StructField(c, T.DoubleType()) for c in ("expected_grade", "tail_probability")]])
    found = narrow.mapInArrow(scored, schema)
    return found.select(F.col("id").alias(id_col), "expected_grade", "tail_probability", (F.col("tail_probability") >= 0.5).alias("kept"))
