"""Toxicity scores: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A text is the bag of the character n-grams of its words.  The mean of their embedding
vectors goes through a linear layer and a softmax; vectors and layer are learned together
with Adam.  Unseen spellings share n-grams, so they share vectors.  After training, a
vector counts only through its dot product with the layer, so scoring sums one number per
n-gram: exact, and one pass over whole texts without a shuffle.

Training takes at most ``per_class`` labelled texts of each class, those whose ids hash
lowest; everything else covers all rows.  Rows whose ``crc32(id as text) mod 5`` is 0 are
held out.

Edge cases: ids may have any type; a text without n-grams (null, empty, white space or signs only) gets the score of the bias
alone; ids with several labels count as toxic if one says so; null labels are left out;
without both classes among the labels every score is the share of toxic labels; repeated
rows each get a row; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.shared import bounded_batches, col, cut
from tidemark.llm.subwords import frequent, ngrams
from tidemark.llm.words import Words, coded, slices

SIZES = (3, 4, 5, 6)
BITS = 20
DIMENSIONS = 8
PER_CLASS = 1500
STEPS = 100
#: Neutral n-grams that every text is taken to have besides its own, so that a few words prove little.
PADDING = 300.0
RATE = 0.15
DECAY = 0.0
#: n-grams in fewer training texts, or in fewer than LEAST_SHARE of a thousand, are left out.
LEAST_TEXTS = 5
LEAST_SHARE = 2


def damped(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, word and weight of each distinct word of each text: a word said n times counts 1 + ln n times."""
    size = max(len(words.vocabulary), 1)
    pairs, times = np.unique(np.repeat(np.arange(len(words.starts) - 1), np.diff(words.starts)) * size + words.codes, return_counts=True)
    return pairs // size, pairs % size, 1 + np.log(times)


@dataclass
class Model:
    """logit(toxic) = bias + mean of ``weights`` over the n-grams of a text and the padding."""

    weights: np.ndarray
    bias: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        words = coded(texts)
        bucket, owner = ngrams(words.vocabulary, SIZES, BITS)
        size = len(words.vocabulary)
        row, code, times = damped(words)
        total = np.bincount(row, times * np.bincount(owner, self.weights[bucket], size)[code], len(texts))
        count = np.bincount(row, times * np.bincount(owner, minlength=size)[code], len(texts))
        return 1 / (1 + np.exp(-np.clip(self.bias + total / (count + PADDING), -50, 50)))


def train(texts: pa.Array, toxic: np.ndarray, seed: int = 7) -> Model:
    """Fit embeddings and softmax by full-batch Adam; both classes weigh the same."""
    share = float(toxic.mean()) if len(toxic) else 0.0
    if share in (0.0, 1.0):
        return Model(np.zeros(1 << BITS, np.float32), float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    words = coded(texts)
    size, rows = len(words.vocabulary), len(toxic)
    row, code, times = damped(words)
    least = max(LEAST_TEXTS, LEAST_SHARE * rows // 1000)
    names, at, owner, grams = frequent(words.vocabulary, np.bincount(code, minlength=size), least, SIZES, BITS)
    length = np.bincount(row, times * grams[code], rows) + PADDING
    part = times / length[row]  # an n-gram's share in its text

    rng = np.random.default_rng(seed)
    params = {"E": rng.normal(0, 0.1, (DIMENSIONS, len(names))), "W": rng.normal(0, 1, (DIMENSIONS, 2)), "b": np.zeros(2)}
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in params.items()}
    truth = np.stack([1 - toxic, toxic], 1).astype(float)
    weight = np.where(toxic == 1, 0.5 / share, 0.5 / (1 - share))[:, None] / rows
    for step in range(1, STEPS + 1):
        E, W = params["E"], params["W"]
        vectors = [np.bincount(owner, e[at], size) for e in E]
        H = np.stack([np.bincount(row, part * v[code], rows) for v in vectors], 1)
        z = H @ W + params["b"]
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        dz = (p - truth) * weight
        dH = dz @ W.T
        grads = {"W": H.T @ dz + DECAY * W, "b": dz.sum(0)}
        grads["E"] = np.stack([np.bincount(at, np.bincount(code, part * dH[row, d], size)[owner], len(names)) for d in range(DIMENSIONS)])
        for k, g in grads.items():
            m, v = moments[k]
            m += 0.1 * (g - m)
            v += 0.001 * ((g * g).mean() - v)
            params[k] -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-10)
    weights = np.zeros(1 << BITS, np.float32)
    weights[names] = (params["W"][:, 1] - params["W"][:, 0]) @ params["E"]
    return Model(weights, float(params["b"][1] - params["b"][0]))


def held_out(key):
    """The rows that no training may see."""
    return F.crc32(F.encode(key.cast("string"), "UTF-8")) % 5 == 0


def sample(labels: DataFrame, id_col: str, label: str, per_class: int) -> DataFrame:
    """At most ``per_class`` ids of each class among those not held out: rows (id, y)."""
    known = labels.where(col(id_col).isNotNull() & col(label).isNotNull() & ~held_out(col(id_col)))
    known = known.groupBy(col(id_col).alias("id")).agg(F.max(col(label)).cast("int").alias("y"))
    classes = [known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(per_class) for y in (0, 1)]
    return cut(classes[0].union(classes[1]))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic", per_class: int = PER_CLASS) -> DataFrame:
    """One row per text: id, held_out, score and predicted."""
    narrow = bounded_batches(docs).select(col(id_col).alias("id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    schema = T.StructType([narrow.schema["id"], T.StructField("score", T.DoubleType())])
    picked = narrow.join(F.broadcast(sample(labels, id_col, label, per_class)), "id")  # bounded by per_class
    data = picked.select("id", "text", "y").toArrow().sort_by("id")
    toxic = data.column("y").to_numpy()
    made = train(data.column("text").combine_chunks(), toxic)
    learned = narrow.sparkSession.sparkContext.broadcast((made.weights, made.bias))  # plain values: workers need no copy of this package

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*learned.value)
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(model.scores(batch.column("text")))], ["id", "score"])

    return narrow.mapInArrow(scored, schema).select(
        F.col("id").alias(id_col),
        F.coalesce(held_out(F.col("id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
