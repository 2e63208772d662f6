"""Benchmark decontamination: a BM25 index of the test items, queried with every passage.

Passages are windows of words, half overlapping, twice as long as the longest item, so each
run as long as an item lies within one.  Words are compared in lower case without signs.
An item's BM25 impacts are divided by their sum, so the score is the weighted share of the
item that the passage has; all items above ``threshold`` are wanted.

With a fixed threshold, block-max WAND needs no heap and runs on many passages at once:
a passage whose terms' largest impacts sum to less than the threshold is skipped; then
blocks of items are skipped by their largest impacts per term; only postings in the blocks
left are scored.  Retrieved items are verified: at least ``overlap`` of the word three-grams
of the question (all sentences but the last) and of the answer (the last) occur in the
passage.  An item of one sentence is all question.

The index is built per shard of some ``SHARD_ITEMS`` items and ``SHARD_BYTES``, so what is
broadcast has a bound; document frequencies cover all items.  Nothing of the corpus is shuffled.

Edge cases: ids may have any type; null and empty texts match nothing, as do items without words; repeated items
and rows each match; null ids stay null; an empty table on either side gives no rows; other
columns are not read, or pass through :func:`drop_contaminated`.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.shared import bounded_batches, col, cut, fresh
from tidemark.llm.words import coded, slices, spread

THRESHOLD = 0.5
OVERLAP = 0.6
GRAM = 3
K1, B = 1.2, 0.75
BLOCK_ITEMS = 8
SHARD_ITEMS = 20_000
SHARD_BYTES = 32 << 20
#: Postings expanded at once.
EXPANDED = 4_000_000
_SIGNS = re.compile(r"[\W_]+")
_SENTENCE = re.compile(r"(?<=[.?!])\s+|\n+")


def plain(word: str) -> str:
    return word.lower() if word.isalnum() else _SIGNS.sub("", word).lower()


def terms_of(text: str | None) -> list[str]:
    return [t for t in map(plain, (text or "").split()) if t]


def question_and_answer(text: str | None) -> tuple[list[str], list[str]]:
    parts = [t for t in map(terms_of, _SENTENCE.split(text or "")) if t]
    if len(parts) < 2:
        return (parts or [[]])[0], []
    return [t for p in parts[:-1] for t in p], parts[-1]


@dataclass
class Index:
    """Postings by term, with the largest impact per term and per block of items."""

    items: list = field(default_factory=list)
    term: dict[str, int] = field(default_factory=dict)
    parts: list[tuple] = field(default_factory=list)
    window: int = 64

    @classmethod
    def build(cls, rows: list[tuple], frequency: dict[str, int], total: int, mean: float) -> Index:
        """rows: (item id, text); frequency, total and mean length are those of all items."""
        self, found = cls(), []
        for item, text in rows:
            words = terms_of(text)
            if not words:
                continue
            impact = {}
            for t, n in Counter(words).items():
                df = frequency.get(t, 1)
                idf = np.log(1 + (total - df + 0.5) / (df + 0.5))
                impact[self.term.setdefault(t, len(self.term))] = idf * n * (K1 + 1) / (n + K1 * (1 - B + B * len(words) / mean))
            whole = sum(impact.values())
            found += [(t, len(self.items), w / whole) for t, w in impact.items()]
            self.items.append(item)
            self.parts.append(tuple([self.term[t] for t in part] for part in question_and_answer(text)))
            self.window = max(self.window, 2 * len(words))
        found.sort()
        terms = np.array([f[0] for f in found], np.int64)
        self.item, self.impact = np.array([f[1] for f in found], np.int64), np.array([f[2] for f in found])
        size = len(self.term)
        self.start = np.searchsorted(terms, np.arange(size + 1))
        self.most = np.array([self.impact[a:b].max() for a, b in zip(self.start[:-1], self.start[1:], strict=True)]) if size else np.zeros(0)
        self.blocks = len(self.items) // BLOCK_ITEMS + 1
        key, at = np.unique(terms * self.blocks + self.item // BLOCK_ITEMS, return_inverse=True)
        self.block = key % self.blocks
        self.block_most = np.zeros(len(key))
        np.maximum.at(self.block_most, at, self.impact)
        self.block_start = np.searchsorted(key // self.blocks, np.arange(size + 1))
        return self

    def search(self, passage: np.ndarray, term: np.ndarray, threshold: float) -> Iterator[tuple[int, int, float]]:
        """(passage, item, score) at or above the threshold; the pairs (passage, term) are distinct and sorted."""
        if not len(passage):
            return
        low = threshold - 1e-9
        bound = np.bincount(passage, self.most[term])
        chosen = bound[passage] >= low
        passage, term = passage[chosen], term[chosen]
        upto = np.cumsum(self.block_start[term + 1] - self.block_start[term])
        ends = np.flatnonzero(np.append(passage[1:] != passage[:-1], True)) + 1 if len(passage) else []
        at = 0
        while at < len(passage):
            most = (upto[at - 1] if at else 0) + EXPANDED
            fits = ends[(ends > at) & (upto[np.asarray(ends) - 1] <= most)]
            end = int(fits[-1]) if len(fits) else int(ends[ends > at][0])
            yield from self._scored(passage[at:end], term[at:end], low)
            at = end

    def _scored(self, passage: np.ndarray, term: np.ndarray, low: float) -> Iterator[tuple[int, int, float]]:
        names, own = np.unique(passage, return_inverse=True)
        lengths = self.block_start[term + 1] - self.block_start[term]
        at = spread(self.block_start[term], lengths)
        bound = np.bincount(np.repeat(own, lengths) * self.blocks + self.block[at], self.block_most[at], len(names) * self.blocks)
        alive = bound >= low
        busy = alive.reshape(len(names), self.blocks).any(1)[own]
        own, term = own[busy], term[busy]
        lengths = self.start[term + 1] - self.start[term]
        at = spread(self.start[term], lengths)
        own = np.repeat(own, lengths)
        ok = alive[own * self.blocks + self.item[at] // BLOCK_ITEMS]
        pair, where = np.unique(own[ok] * len(self.items) + self.item[at[ok]], return_inverse=True)
        score = np.bincount(where, self.impact[at[ok]], len(pair))
        for p, s in zip(pair[score >= low].tolist(), score[score >= low].tolist(), strict=True):
            yield int(names[p // len(self.items)]), p % len(self.items), s

    def overlap(self, item: int, words: list[int]) -> tuple[float, float]:
        """The shares of question and answer three-grams that the words have in a row."""
        out = []
        for part in self.parts[item]:
            n = min(GRAM, len(part))
            grams = {tuple(part[i : i + n]) for i in range(len(part) - n + 1)} if part else set()
            has = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if grams else set()
            out.append(len(grams & has) / len(grams) if grams else 1.0)
        return out[0], out[1]

    def matches(self, texts: pa.Array, threshold: float, overlap: float) -> Iterator[tuple[int, int, float, float, float]]:
        """(text, item, score, question overlap, answer overlap), the best passage of each pair."""
        words = coded(texts)
        known = np.array([-2 if not (t := plain(w)) else self.term.get(t, -1) for w in words.vocabulary], np.int64)
        found = known[words.codes] if len(words.codes) else np.zeros(0, np.int64)
        upto = np.concatenate([[0], np.cumsum(found != -2)])
        starts, found = upto[words.starts], found[found != -2]
        sizes = np.diff(starts)
        half = self.window // 2
        count = np.maximum(1, -(-sizes // half) - 1)  # passages a text
        base = np.concatenate([[0], np.cumsum(count)])
        text = np.repeat(np.arange(len(sizes)), sizes)
        step = (np.arange(len(found)) - starts[text]) // half
        late = np.minimum(step, count[text] - 1)
        hit = found >= 0
        both = hit & (step > 0) & (step - 1 != late)
        passage = np.concatenate([(base[text] + late)[hit], (base[text] + step - 1)[both]])
        pairs = np.unique(passage * max(len(self.term), 1) + np.concatenate([found[hit], found[both]]))
        size = max(len(self.term), 1)
        best: dict[tuple[int, int], tuple[float, float, float]] = {}
        for p, item, score in self.search(pairs // size, pairs % size, threshold):
            t = int(np.searchsorted(base, p, "right")) - 1
            first = int(starts[t]) + (p - int(base[t])) * half
            q, a = self.overlap(item, found[first : min(first + self.window, int(starts[t + 1]))].tolist())
            if q >= overlap and a >= overlap:
                best[t, item] = max(best.get((t, item), (0.0, 0.0, 0.0)), (q + a, score, q))
        for (t, item), (both_, score, q) in sorted(best.items()):
            yield t, item, score, q, both_ - q


def _frequencies(items: DataFrame, shards: int) -> DataFrame:
    """Rows (shard, term, df, words): document frequencies over all items, for each shard's terms."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard, term, n = [], [], []
            for s, text in zip(batch.column("shard").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for t, times in Counter(terms_of(text)).items():
                    shard.append(s)
                    term.append(t)
                    n.append(times)
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), pa.array(term, pa.string()), pa.array(n, pa.int64())], ["shard", "term", "n"])

    found = items.mapInArrow(listed, "shard int, term string, n long").groupBy("shard", "term").agg(F.count(F.lit(1)).alias("df"), F.sum("n").alias("n"))
    if shards == 1:
        return found
    found = cut(found)
    return found.select("shard", "term").join(found.groupBy("term").agg(F.sum("df").alias("df"), F.sum("n").alias("n")), "term").select("shard", "term", "df", "n")


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
    threshold: float = THRESHOLD, overlap: float = OVERLAP,
) -> DataFrame:
    """One row per text and test item found in it: id, item_id, score, question_overlap, answer_overlap."""
    spark = docs.sparkSession
    narrow = bounded_batches(docs).select(col(id_col).alias("id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    items = benchmark.select(col(item_col).alias("item"), F.coalesce(col(item_text), F.lit("")).alias("text"))
    names = ["id", "item_id", "score", "question_overlap", "answer_overlap"]
    kinds = [narrow.schema["id"].dataType, items.schema["item"].dataType, *[T.DoubleType()] * 3]
    schema = T.StructType([T.StructField(c, k) for c, k in zip(names, kinds, strict=True)])
    arrow = to_arrow_schema(schema).types
    total, size = benchmark.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(col(item_text))), F.lit(0))).first()
    shards = max(-(-total // SHARD_ITEMS), -(-size // SHARD_BYTES))
    items = cut(items.withColumn("shard", F.pmod(F.xxhash64("item", "text"), F.lit(max(shards, 1))).cast("int")))
    frequency = cut(_frequencies(items, shards))
    words = frequency.where("shard = 0").agg(F.sum("n")).first()[0] if shards == 1 else frequency.select("term", "n").distinct().agg(F.sum("n")).first()[0]
    mean = (words or 0) / total if total else 0.0
    found = spark.createDataFrame([], schema)
    for shard in range(shards):
        rows = sorted(((r.item, r.text) for r in items.where(F.col("shard") == shard).collect()), key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0, r[1]))
        known = {r.term: r.df for r in frequency.where(F.col("shard") == shard).collect()}
        made = vars(Index.build(rows, known, total, mean or 1.0))  # plain values: workers need no copy of this package
        shared = spark.sparkContext.broadcast(made)

        def searched(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Index()
            vars(index).update(shared.value)
            for batch in slices(batches):
                ids = batch.column("id").to_pylist()
                hits = [(ids[t], index.items[i], s, q, a) for t, i, s, q, a in index.matches(batch.column("text"), threshold, overlap)]
                if hits:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*hits, strict=True), arrow, strict=True)], names)

        found = found.union(narrow.mapInArrow(searched, schema))
    return found.withColumnRenamed("id", id_col)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id has no test item in its text."""
    found = contaminated(docs.select(col(id_col).alias("id"), col(text_col).alias("text")), benchmark, "id", "text")
    name = fresh(docs, "bad")
    bad = cut(found.where("id is not null").select(F.col("id").alias(name)).distinct())
    return docs.join(bad, col(id_col) == F.col(name), "left_anti")
