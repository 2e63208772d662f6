"""Packing token sequences: vector bin packing with the dot-product heuristic.

An example demands a vector (tokens, segments, loss-bearing tokens) and a sequence offers
(``capacity``, ``max_segments``, ``max_loss``).  The open sequence takes the example, among
those that fit, whose demand has the largest weighted dot product with what is left; the
weights are each resource's total demand relative to its capacity.  When none fits, the
example with the largest product is cut so that the sequence is filled exactly.  Sequences
that cannot be filled (segments or loss used up, or the end of a partition) are closed in
lengths of powers of two, which need no padding.

Every partition packs its own rows in cells of bounded size and carries what is left from
cell to cell, so nothing is shuffled and a lost task is redone alone.  Sequence ids hold the
partition number.  Words are tokenised once per distinct word: the tokeniser drops white
space, so the ids of a text are those of its white-space-separated words in order.

Edge cases: ids may have any type; null and empty texts are the end id alone; repeated rows are packed each for
itself; null ids stay null; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.shared import bounded_batches, col
from tidemark.llm.words import coded, slices, spread

CELL_TOKENS = 2 << 20
CELL_ROWS = 2048
CACHED_WORDS = 250_000
#: Bytes of text tokenised at once; more of them share more words.
SLICE_BYTES = 6 << 20
#: Shorter power-of-two lengths are made only at the end of a partition.
SHORT = 64

#: What follows the id of a piece.
PIECES = pa.schema([
    ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()), ("offset", pa.int64()), ("loss_tokens", pa.int64()), ("padded_to", pa.int32()), ("ids", pa.list_(pa.int32())),
])


#: A full stop or comma between one of these characters and white space is a piece of its own.
SIGN = r"([A-Za-z0-9À-ÖØ-öø-ÿ])([.,])([ \t\n\r]|$)"


class WordTokenizer:
    """Token ids of white-space-separated words, remembered for a bounded number of them.

    The tokeniser cuts between letters and signs, so final full stops and commas are words
    apart.  Words of lower-case letters alone are one piece each, which its normaliser and
    pattern leave as they are: they go through the same model without both, many in one
    call, and are told apart by the mark of a word's last token.
    """

    TOGETHER = 200

    @classmethod
    def of_process(cls, definition: str) -> WordTokenizer:
        """One per worker process and definition; kept beside the library, as shipped code has no module of its own."""
        import tokenizers

        loaded = vars(tokenizers).setdefault("_word_tokenizers", {})
        key = zlib.crc32(definition.encode()), len(definition), CACHED_WORDS
        if key not in loaded:
            loaded.clear()
            loaded[key] = cls(definition)
        return loaded[key]

    def __init__(self, definition: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(definition)
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab()
        self.word_end = np.zeros(max(vocabulary.values()) + 1, bool)
        self.word_end[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0
        self.ends, self.count = np.zeros(1 << 14, np.int64), 0

    def forget(self, keep: list[str]) -> None:
        """Drop all words but these."""
        at = np.fromiter(map(self.known.__getitem__, keep), np.int64, len(keep))
        starts, lengths = self.ends[at], self.ends[at + 1] - self.ends[at]
        ids = self.flat[spread(starts, lengths)]
        self.clear()
        self._remember(keep, ids, lengths)

    def _remember(self, words: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.count + len(words) >= len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.ends[self.count + 1 : self.count + 1 + len(words)] = self.used + np.cumsum(lengths)
        self.known.update(zip(words, range(self.count, self.count + len(words)), strict=True))
        self.used, self.count = self.used + len(ids), self.count + len(words)

    def learn(self, words: list[str]) -> None:
        plain, other = [], []
        for w in words:
            (plain if w.isalpha() and w == w.lower() and is_normalized("NFC", w) else other).append(w)
        for i in range(0, len(plain), self.TOGETHER):
            part = plain[i : i + self.TOGETHER]
            ids = np.array(self.plain.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.int32)
            ends = np.flatnonzero(self.word_end[ids])
            if len(ends) != len(part):  # some letters are cut after all
                other += part
                continue
            self._remember(part, ids, np.diff(ends, prepend=-1))
        for i in range(0, len(other), self.TOGETHER):
            part = other[i : i + self.TOGETHER]
            found = [e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            self._remember(part, np.array([x for f in found for x in f], np.int32), np.array([len(f) for f in found], np.int64))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's ids start (one more at the end)."""
        words = coded(pc.replace_substring_regex(texts, SIGN, r"\1 \2\3"))
        if len(self.known) > CACHED_WORDS:
            self.forget([w for w in words.vocabulary if w in self.known])
        known = self.known
        self.learn([w for w in words.vocabulary if w not in known])
        if not len(words.codes):
            return np.zeros(0, np.int32), np.zeros(len(words.starts), np.int64)
        at = np.fromiter(map(known.__getitem__, words.vocabulary), np.int64, len(words.vocabulary))[words.codes]
        lengths = self.ends[at + 1] - self.ends[at]
        return self.flat[spread(self.ends[at], lengths)], np.concatenate([[0], np.cumsum(lengths)])[words.starts]


class Packer:
    """Packs the examples of one partition; finished pieces gather in ``done``.

    An item is [id, ids, loss_from, start, end]: the tokens of an example still to be placed.
    """

    def __init__(self, capacity: int, max_segments: int, max_loss: int, first_sequence: int):
        if min(capacity, max_segments, max_loss) < 1:
            raise ValueError("every limit has to be at least 1")
        self.capacity, self.max_segments, self.max_loss = capacity, max_segments, max_loss
        self.sequence = first_sequence
        self.pool: list[list] = []
        self.tokens = 0
        self.done: list[tuple] = []

    def add(self, key, ids: np.ndarray, loss_from: int) -> None:
        self.pool.append([key, ids, loss_from, 0, len(ids)])
        self.tokens += len(ids)

    def full(self) -> bool:
        return self.tokens >= CELL_TOKENS or len(self.pool) >= CELL_ROWS

    def pack(self, last: bool) -> None:
        """Place the pool; unless ``last``, what fills no sequence stays in it."""
        pool = self.pool
        start, end = np.array([x[3] for x in pool], np.int64), np.array([x[4] for x in pool], np.int64)
        loss_from = np.array([x[2] for x in pool], np.int64)
        tokens, loss = end - start, end - np.maximum(start, loss_from)
        np.maximum(loss, 0, out=loss)
        left = int(tokens.sum())
        # A resource in short supply weighs more: its total demand over its capacity.
        w_tokens, w_loss = left / self.capacity**2, float(loss.sum()) / self.max_loss**2
        w_segment = len(pool) / self.max_segments**2
        back: list[list] = []
        while left and (last or left >= self.capacity):
            room, segments, spare, pieces = self.capacity, self.max_segments, self.max_loss, []
            while room and segments and left:
                score = tokens * (w_tokens * room) + loss * (w_loss * spare) + w_segment * segments
                fits = (tokens > 0) & (tokens <= room) & (loss <= spare)
                long = not pieces and tokens.max() >= room
                if not long and fits.any():
                    i = int(np.argmax(np.where(fits, score, -1.0)))
                    take = int(tokens[i])
                else:
                    reach = np.minimum(np.minimum(tokens, room), np.maximum(loss_from - start, 0) + spare)
                    i = int(np.argmax(np.where(reach == reach.max(), score, -1.0)))
                    take = int(reach[i])
                    if not take:
                        break
                pieces.append((i, int(start[i]), int(start[i]) + take))
                start[i] += take
                tokens[i] -= take
                spare -= int(loss[i])
                loss[i] = max(0, int(end[i]) - max(int(start[i]), int(loss_from[i])))
                spare += int(loss[i])
                room, segments, left = room - take, segments - 1, left - take
            back += self.close(pieces, last)
        self.pool = [[x[0], x[1], x[2], int(s), x[4]] for x, s in zip(pool, start, strict=True) if s < x[4]] + back
        self.tokens = sum(x[4] - x[3] for x in self.pool)
        if last and self.pool:
            self.pack(True)

    def close(self, pieces: list[tuple[int, int, int]], last: bool) -> list[list]:
        """Record a sequence; one that is not full goes out in lengths of powers of two.

        Returns as items the few tokens that would make lengths below ``SHORT``.
        """
        total, first = sum(e - s for _, s, e in pieces), True
        while total:
            size = self.capacity if total == self.capacity else 1 << (total.bit_length() - 1)
            if size < SHORT and not last and not first:
                return [[*self.pool[i][:3], s, e] for i, s, e in pieces]
            room, offset, rest = size, 0, []
            for i, s, e in pieces:
                cut = min(e, s + room)
                if cut > s:
                    self.done.append((self.pool[i], s, cut, self.sequence, offset, size))
                    offset, room = offset + cut - s, room - (cut - s)
                if cut < e:
                    rest.append((i, cut, e))
            self.sequence += 1
            pieces, total, first = rest, total - size, False
        return []

    def taken(self, with_ids: bool, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        """The finished pieces as batches."""
        schema = pa.schema([("id", id_type), *PIECES])
        done, self.done = self.done, []
        for at in range(0, len(done), 4096):
            cols: list[list] = [[] for _ in schema]
            for item, s, e, sequence, offset, size in done[at : at + 4096]:
                ids = item[1][s:e]
                row = (item[0], s, e - s, zlib.crc32(ids.astype("<u4").tobytes()), len(item[1]), sequence, offset, max(0, e - max(s, item[2])), size, ids if with_ids else None)
                for c, v in zip(cols, row, strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def pack(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    tokenizer_path: str,
    *,
    prompt_col: str | None = None,
    end_id: int = 2,
    capacity: int = 4096,
    max_segments: int = 128,
    max_loss: int | None = None,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, loss_tokens, padded_to, ids.

    An example is the ids of its prompt (if there is such a column; they bear no loss), then
    those of its text and ``end_id`` (they do).  ``padded_to`` is the sequence's length.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:  # a fixed file of the driver, of 2 MB
        definition = spark.sparkContext.broadcast(f.read())
    most_loss = capacity if max_loss is None else max_loss
    narrow = bounded_batches(docs).select(
        col(id_col).alias("id"),
        F.coalesce(col(text_col), F.lit("")).alias("text"),
        *([F.coalesce(col(prompt_col), F.lit("")).alias("prompt")] if prompt_col else []),
    )

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer.of_process(definition.value)
        packer = Packer(capacity, max_segments, most_loss, TaskContext.get().partitionId() << 36)
        id_type = pa.int64()
        for batch in slices(batches, most=SLICE_BYTES):
            id_type = batch.column("id").type
            ids, starts = tokenizer.encode(batch.column("text"))
            before, first = tokenizer.encode(batch.column("prompt")) if prompt_col else (ids[:0], np.zeros(batch.num_rows + 1, np.int64))
            for i, key in enumerate(batch.column("id").to_pylist()):
                prompt = before[first[i] : first[i + 1]]
                packer.add(key, np.concatenate([prompt, ids[starts[i] : starts[i + 1]], [end_id]]).astype(np.int32), len(prompt))
                if packer.full():
                    packer.pack(False)
                    yield from packer.taken(with_ids, id_type)
        packer.pack(True)
        yield from packer.taken(with_ids, id_type)

    rest = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long, padded_to int, ids array<int>"
    schema = T.StructType([narrow.schema["id"], *T._parse_datatype_string(rest).fields])
    found = narrow.mapInArrow(packed, schema)
    found = found if with_ids else found.drop("ids")
    return found.withColumnRenamed("id", id_col)
