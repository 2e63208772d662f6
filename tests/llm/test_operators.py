"""Each operator against a plain version, on texts with every edge case."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import (
    components,
    decontamination,
    jaccard_join,
    license_scan,
    line_dedup,
    packing,
    quality_classifier,
    quality_rules,
    sharding,
    substring_dedup,
    subwords,
    toxicity,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, id string, rep int, kept string, shard string"


def base_texts() -> list[str | None]:
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    sentence = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    texts: list[str | None] = [None, "", "   \n\t ", "one", "one two", "One TWO", "a b c", "x\x0by\x0cz"]
    passage = sentence(60)
    for _ in range(25):
        lines = [sentence(rng.randint(5, 40)) + "." for _ in range(rng.randint(1, 6))]
        texts.append("\n".join(lines))
    for base in texts[10:18]:
        words = base.split(" ")
        for _ in range(3):
            copy = list(words)
            copy[rng.randrange(len(copy))] = "edited"
            texts.append(" ".join(copy))
    texts += [texts[12], texts[12], texts[13]]  # copies
    texts += [sentence(30) + " " + passage + " " + sentence(20) for _ in range(4)]
    texts += ["same line\n" * 9, "A A A A " * 40, sentence(12000), "head\n\n" + (texts[14] or "")]
    texts += ["Tom's 3.5%, café naïve. Étude, <|endoftext|> x.y, Straße İstanbul 12,5. end.", "#tag *** $5 <b> | &"]
    return texts


@pytest.fixture(scope="module")
def rows():
    found = [(i, t, "en" if i % 3 else "de", f"s{i % 2}", len(t or ""), 1, "x", 2, "k", "s") for i, t in enumerate(base_texts())]
    found += [found[20], found[20]]  # rows that repeat, id and all
    found += [(None, "a text without an id of some words", None, None, 5, 1, "x", 2, "k", "s")]
    return found


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def crc(text):
    return zlib.crc32((text or "").encode())


def test_sharding(docs, empty, rows):
    found = sharding.shard_records(docs, "doc_id", "text", [1.0] * 7).collect()
    assert Counter((r.doc_id, r.text_crc32, r["size"]) for r in found) == Counter((r[0], crc(r[1]), len((r[1] or "").encode()) + 16) for r in rows)
    slots = defaultdict(list)
    by_key = defaultdict(set)
    for r in found:
        slots[r.shard].append(r.slot)
        by_key[r.doc_id].add((r.shard, r.grown_shard))
        assert r.grown_shard in (r.shard, 7) and 0 <= r.shard < 7 and r.law == "key"
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(v) == 1 for v in by_key.values())
    grown = {r.doc_id: r.shard for r in sharding.shard_records(docs, "doc_id", "text", [1.0] * 8).collect()}
    assert grown == {k: next(iter(v))[1] for k, v in by_key.items()}
    assert sharding.shard_records(empty, "doc_id", "text", [1.0]).count() == 0


def test_sharding_weights(spark):
    keys = spark.range(4000).selectExpr("id as doc_id", "'t' as text")
    count = Counter(r.shard for r in sharding.shard_records(keys, "doc_id", "text", [1.0, 3.0]).collect())
    assert 2.4 < count[1] / count[0] < 3.7
    with pytest.raises(ValueError):
        sharding.shard_of(keys.doc_id, [1.0, 0.0])


def counts(text):
    words = WORD.findall(text or "")
    n = len(words)
    windows = Counter(tuple(words[i : i + 3]) for i in range(n - 2))
    covered = {j for i in range(n - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_quality_counts(docs, empty, rows):
    found = quality_rules.score(docs).collect()
    expected = Counter((r[0], *counts(r[1])) for r in rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found) == expected
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in found)
    assert not any(r.kept and r.base_failed for r in found)
    assert quality_rules.score(empty).count() == 0


def test_quality_fences_adapt(spark):
    rng = random.Random(1)
    text = lambda sign: " ".join(f"w{rng.randrange(10**6)}{sign}" for _ in range(80))
    rows = [(i, text(""), "en", "a") for i in range(300)] + [(300, text("#"), "en", "a")]
    rows += [(1000 + i, text("#"), "en", "b") for i in range(300)]
    found = {r.doc_id: r.kept for r in quality_rules.score(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not found[300] and all(found[i] for i in range(300)) and all(found[1000 + i] for i in range(300))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumnRenamed("doc_id", "__tidemark_kept")
    kept = quality_rules.keep_good(frame)
    assert kept.columns == ["__tidemark_kept", "text", "lang", "source"] and kept.count() == 600


def test_quality_slow_path_equals_fast(spark, monkeypatch):
    frame = spark.createDataFrame([(t,) for t in base_texts()], "text string")
    fast = [r.n for r in quality_rules.with_counts(frame, "text", {"n_repeat_words": "n"}).collect()]
    monkeypatch.setattr(quality_rules, "_POS_BITS", 14)  # the longest text has 12000 words
    assert [r.n for r in quality_rules.with_counts(frame, "text", {"n_repeat_words": "n"}).collect()] == fast
    monkeypatch.setattr(quality_rules, "_POS_BITS", 5)
    assert [r.n for r in quality_rules.with_counts(frame, "text", {"n_repeat_words": "n"}).collect()] == fast


def shingles(text, n):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80), (2, 60)])
def test_jaccard_join(docs, rows, n, percent):
    sets = [shingles(r[1], n) for r in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(len(rows)):
            if i != j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                links[i] += 1
                up[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(least.get(root(i), 10**9), r[0])
    expected = Counter((r[0], len(sets[i]), least.get(root(i), r[0]), links[i]) for i, r in enumerate(rows))
    found = jaccard_join.near_duplicates(docs, n=n, percent=percent).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in found) == expected


def test_jaccard_join_ids_with_several_texts(spark):
    """One id on two texts, each near another one; ids that are text; and a pair exactly at the threshold."""
    words = [[f"a{i}" for i in range(60)], [f"b{i}" for i in range(60)]]
    rows = [("u-1", words[0]), ("u-1", words[1]), ("u-2", words[0] + ["x"]), ("u-3", words[1] + ["y"]), (None, words[1] + ["z"])]
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id string, text string")
    found = sorted((str(r.doc_id), r.component_id, r.n_links) for r in jaccard_join.near_duplicates(frame).collect())
    assert found == [("None", "u-1", 2), ("u-1", "u-1", 1), ("u-1", "u-1", 2), ("u-2", "u-1", 1), ("u-3", "u-1", 2)]
    assert {(r.doc_id, r.text[:1]) for r in jaccard_join.keep_one(frame, n=3, percent=90).collect()} == {("u-1", "a"), ("u-1", "b"), (None, "b")}
    assert jaccard_join.Rule(3, 90).linked(np.array([176787, 176786]), np.array([373217, 373217])).tolist() == [True, False]


def test_jaccard_blocks(spark, monkeypatch):
    """A cluster over many blocks, and fragments of few columns, give the same as one block."""
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 3)
    monkeypatch.setattr(jaccard_join, "CELLS", 64)
    rng = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    texts = [[w if rng.random() > 0.02 else f"e{rng.random()}" for w in base] for _ in range(40)]
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    sets = [shingles(" ".join(t), 3) for t in texts]
    links = [sum(i != j and 100 * len(a & b) >= 90 * len(a | b) for j, b in enumerate(sets)) for i, a in enumerate(sets)]
    assert [r.n_links for r in jaccard_join.near_duplicates(frame).orderBy("doc_id").collect()] == links


def test_jaccard_sends_no_texts(spark, monkeypatch):
    """Neither the many candidates nor what is kept is joined by a shuffle of texts; halves of signatures in common lose nothing."""
    from tidemark.llm import shared

    rng = random.Random(5)
    base = [[f"w{k}-{i}" for i in range(60)] for k in range(30)]
    texts = [" ".join(w if rng.random() > 0.01 else f"e{rng.random()}" for w in base[i % 30]) for i in range(90)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = sorted(r.doc_id for r in jaccard_join.keep_one(frame).collect())
    links = [tuple(r) for r in jaccard_join.near_duplicates(frame, n=3, percent=80).orderBy("doc_id").collect()]
    for name, value in (("BROADCAST_SETS", 0), ("SHORT", np.uint64(3)), ("KEY_BYTES", 1), ("BUCKET_KEYS", 5)):
        monkeypatch.setattr(jaccard_join, name, value)
    monkeypatch.setattr(jaccard_join, "LEAST_BUCKETS", 2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = jaccard_join.keep_one(frame)
        assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.doc_id for r in kept.collect()) == expected
        assert [tuple(r) for r in jaccard_join.near_duplicates(frame, n=3, percent=80).orderBy("doc_id").collect()] == links
        monkeypatch.setattr(shared, "AMONG_ROWS", 0)
        assert sorted(r.doc_id for r in jaccard_join.keep_one(frame).collect()) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_jaccard_packed_keys():
    """A chunk's keys cost half of two longs each, and come back with their owners."""
    rng = np.random.default_rng(1)
    keys, ids = rng.integers(0, 1 << 63, 50_000, np.uint64), np.sort(rng.integers(0, 1 << 62, 50_000))
    ids[1], keys[0] = ids[0], keys[49_999]
    batch = jaccard_join._sent([keys], [ids], 8)
    assert sum(batch.column(c).get_total_buffer_size() for c in ("keys", "owners")) < 10 * 50_100
    assert jaccard_join._bucket_edges(pa.Table.from_batches([batch])).num_rows >= 1


def test_jaccard_keep_one(docs, empty):
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert jaccard_join.keep_one(empty).count() == 0 and jaccard_join.near_duplicates(empty).count() == 0
    component = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(docs, n=5, percent=80).collect()}
    assert {r.doc_id for r in kept.collect()} == {None} | {d for d, c in component.items() if d == c}


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(500, 500), (rng.randrange(200, 220), rng.randrange(200, 220))]
    found = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    groups = defaultdict(set)
    for r in found:
        groups[r.root].add(r.id)
    big = sorted(map(len, groups.values()))[-2:]
    assert big == [50, 61] and 500 not in {r.id for r in found}


def gone_lines(rows, m, long=50):
    """Line numbers that repeat an earlier run of m lines, or a line of so many words, per (id, text)."""
    seen, out = set(), {}
    keys = sorted({(r[0], r[1]) for r in rows}, key=lambda k: (k[0] is not None, k[0] or 0, k[1] or ""))
    for key in keys:
        lines = [(i, x.strip(" \t\n\x0b\f\r")) for i, x in enumerate((key[1] or "").split("\n")) if WORD.search(x)]
        gone = set()
        for i in range(len(lines) - m + 1):
            window = tuple(x for _, x in lines[i : i + m])
            if window in seen:
                gone |= {j for j, _ in lines[i : i + m]}
            seen.add(window)
        for j, x in lines:
            if m > 1 and len(WORD.findall(x)) >= long:
                gone |= {j} if (x,) in seen else set()
                seen.add((x,))
        out[key] = sorted(gone)
    return out


@pytest.mark.parametrize("m", [1, 2, 3])
def test_line_dedup(docs, rows, m):
    expected = gone_lines(rows, m)
    found = line_dedup.with_kept_text(docs, "doc_id", "text", m, "left", "gone").collect()
    assert len(found) == len(rows)
    for r in found:
        gone = expected[r.doc_id, r.text]
        assert r.gone == gone
        assert r.left == (r.text if not gone else "\n".join(x for i, x in enumerate(r.text.split("\n")) if i not in gone))


def test_line_dedup_long_lines(spark):
    line = " ".join(f"w{i}" for i in range(50))
    frame = spark.createDataFrame([("b", f"head b\n{line}\nmore b"), ("a", f"{line}\nmore a"), ("c", f"{line} x"), ("d", line[:-4])], "doc_id string, text string")
    found = {r.doc_id: (r.removed_lines, r.kept, r.longest_run) for r in line_dedup.runs_of_texts(frame).collect()}
    assert found == {"a": ([], f"{line}\nmore a", 1), "b": ([1], "head b\nmore b", 1), "c": ([], f"{line} x", 0), "d": ([], line[:-4], 0)}


def test_line_dedup_run_lengths(spark):
    """The longest common prefix of every suffix with any other, in texts of few different lines."""
    rng = random.Random(2)
    texts = [[rng.choice("abc") for _ in range(rng.randint(0, 8))] for _ in range(7)]
    texts += [texts[0][:7] + ["z"] + texts[2][:3], texts[3][2:7], [f"u{i}" for i in range(9)], ["q"] + [f"u{i}" for i in range(7)]]
    frame = spark.createDataFrame([(i, "\n".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    spots = [(d, i) for d, t in enumerate(texts) for i in range(len(t))]

    def common(a, b):
        n = 0
        while a[1] + n < len(texts[a[0]]) and b[1] + n < len(texts[b[0]]) and texts[a[0]][a[1] + n] == texts[b[0]][b[1] + n]:
            n += 1
        return n

    expected = {s: most for s in spots if (most := max((common(s, t) for t in spots if t != s), default=0))}
    active = line_dedup.repeated_lines(line_dedup.line_ids(frame, "doc_id", "text"))
    found = line_dedup.run_lengths(active).collect()
    assert len(found) == len(expected) and {(r.id.id, r.idx): r.run for r in found} == expected


def test_line_dedup_drops_emptied(spark, docs, empty):
    frame = spark.createDataFrame([(1, "a b\nc d"), (2, "a b\nc d"), (3, ""), (4, "x\na b\nc d\ny")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in line_dedup.drop_repeated(frame).collect()} == {1: "a b\nc d", 3: "", 4: "x\ny"}
    assert line_dedup.drop_repeated(docs).columns == docs.columns and line_dedup.drop_repeated(empty).count() == 0
    assert line_dedup.runs_of_texts(empty).count() == 0 and line_dedup.runs_of_texts(docs).count() == docs.count()
    with pytest.raises(ValueError):
        line_dedup.drop_repeated(frame, min_lines=0)


@pytest.fixture(scope="module")
def tokenizer_path():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


@pytest.mark.parametrize("limits", [{}, {"capacity": 256, "max_segments": 5, "max_loss": 100}, {"capacity": 64, "max_segments": 1}])
def test_packing_round_trip(docs, rows, tokenizer_path, limits):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path)
    prompted = docs.selectExpr("doc_id", "text", "case when doc_id % 2 = 0 then 'Say it, please.' end as ask")
    found = packing.pack(prompted, "doc_id", "text", tokenizer_path, prompt_col="ask", **limits).collect()
    capacity = limits.get("capacity", 4096)
    ids = lambda t: tokenizer.encode(t or "", add_special_tokens=False).ids
    whole = {}
    for r in rows:
        asked = ids("Say it, please.") if r[0] is not None and r[0] % 2 == 0 else []
        whole[r[0]] = (asked + ids(r[1]) + [2], len(asked))
    tokens = Counter()
    sequences = defaultdict(list)
    for r in found:
        own, prompt = whole[r.doc_id]
        assert r.ids == own[r.start : r.start + r.length] and r.doc_tokens == len(own)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        assert r.loss_tokens == max(0, r.start + r.length - max(r.start, prompt))
        tokens.update({(r.doc_id, i): 1 for i in range(r.start, r.start + r.length)})
        sequences[r.sequence_id].append(r)
    times = Counter(r[0] for r in rows)
    assert tokens == Counter({(d, i): times[d] for d, (own, _) in whole.items() for i in range(len(own))})
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == pieces[0].padded_to and at <= capacity and (at == capacity or at & (at - 1) == 0)
        assert len(pieces) <= limits.get("max_segments", 128)
        assert sum(r.loss_tokens for r in pieces) <= limits.get("max_loss", capacity)


def test_packing_cells(spark, empty, tokenizer_path, monkeypatch):
    monkeypatch.setattr(packing, "CELL_ROWS", 7)
    monkeypatch.setattr(packing, "CACHED_WORDS", 20)
    frame = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(i % 90))) for i in range(200)], "doc_id long, text string").coalesce(1)
    found = packing.pack(frame, "doc_id", "text", tokenizer_path, capacity=128).collect()
    assert sum(r.length for r in found) == sum(r.doc_tokens for r in found if r.start == 0)
    lengths = Counter(r.padded_to for r in found if r.offset == 0)
    assert lengths[128] >= sum(lengths.values()) - 8
    assert packing.pack(empty, "doc_id", "text", tokenizer_path).count() == 0


def test_decontamination(spark, docs, empty):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("klmnopqrst") for _ in range(6))
    items = [" ".join(word() for _ in range(20)) + ". " + " ".join(word() for _ in range(6)) + "." for _ in range(30)] + ["single words only", None, ""]
    items.append(items[3])
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    filler = lambda n: " ".join(rng.choice(["the", "of", "and", word()]) for _ in range(n))
    texts = [filler(200) for _ in range(20)] + [filler(97) + "\n" + items[i].upper().replace(".", " !") + " " + filler(50) for i in range(10)] + [None, ""]
    texts += [" ".join(items[1].split()[:12]), items[2].split(".")[0]]  # a part, and a question without its answer
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontamination.contaminated(frame, bench).collect()}
    assert found == {(20 + i, i) for i in range(10)} | {(23, 33)}
    kept = {r.doc_id for r in decontamination.drop_contaminated(frame, bench).collect()}
    assert kept == set(range(len(texts))) - set(range(20, 30))
    assert decontamination.contaminated(empty, bench).count() == 0
    assert decontamination.contaminated(frame, bench.limit(0)).count() == 0
    assert decontamination.drop_contaminated(docs, bench).count() == docs.count()


def test_decontamination_shards(spark, monkeypatch):
    items = [(i, " ".join(f"t{i}x{j}" for j in range(12)) + " of the") for i in range(40)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame([(i, f"of the and {t} and so on") for i, t in items], "doc_id long, text string")
    one = sorted(map(tuple, decontamination.contaminated(frame, bench).collect()))
    monkeypatch.setattr(decontamination, "SHARD_ITEMS", 9)
    assert [r[:2] for r in one] == [(i, i) for i in range(40)]
    assert sorted(tuple(r)[:2] for r in decontamination.contaminated(frame, bench).collect()) == [r[:2] for r in one]


def test_block_max_search_is_exhaustive():
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(f"v{j}" for j in rng.zipf(1.3, 15) % 80)) for i in range(60)]
    frequency = Counter(t for _, text in rows for t in set(text.split()))
    index = decontamination.Index.build(rows, frequency, 60, 15.0)
    dense = np.zeros((len(index.term), 60))
    for t in range(len(index.term)):
        dense[t, index.item[index.start[t] : index.start[t + 1]]] = index.impact[index.start[t] : index.start[t + 1]]
    passages = [np.unique(rng.integers(0, len(index.term), 25)) for _ in range(50)]
    for threshold in (0.2, 0.5, 0.8):
        expected = {(p, i) for p, terms in enumerate(passages) for i in range(60) if dense[terms, i].sum() >= threshold - 1e-9}
        own, term = np.repeat(np.arange(50), [len(p) for p in passages]), np.concatenate(passages)
        assert {(p, i) for p, i, _ in index.search(own, term, threshold)} == expected


def test_license_scan(spark, docs, empty):
    mit = next(t for i, t in license_scan.KNOWN if i == "MIT" and len(t) > 200)
    variants = [mit, "Copyright (c) 2020 Someone\n\n" + mit.upper(), mit.replace("sublicense", "sub-licence").replace("COPYRIGHT HOLDERS", "copyright owners"), mit + " more"]
    texts = variants + ["some text\nLicensed under the Apache Licence, version 2.0\nLicensed under CC BY-NC 4.0.", None, "", "Copyright 2020 A B"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in license_scan.scan(frame).collect()}
    assert [found[i].license for i in range(8)] == ["MIT", "MIT", "MIT", None, None, None, None, None]
    assert found[4].notices == ["Apache-2.0", "CC-BY-NC-4.0"] and found[7].digest is None and found[5].notices == []
    assert license_scan.scan(docs).count() == docs.count() and license_scan.scan(empty).count() == 0


def test_license_scan_whole_texts(spark):
    from pathlib import Path

    folder = Path(license_scan.__file__).parent / "licenses"
    files = {f.stem: f.read_text() for f in folder.glob("*.txt")}
    given = {k: next(t for i, t in license_scan.KNOWN if i == k and len(t) > 200) for k in ("MIT", "ISC", "Unlicense")}
    cases = [*files.items(), *given.items()]
    cases += [("MIT", "MIT License\n\nCopyright (c) 2020 A B\n\n" + given["MIT"]), ("ISC", "ISC License\n\nCopyright 2020 A B\n\n" + given["ISC"])]
    cases += [("BSD-3-Clause", "BSD 3-Clause License\n\nCopyright (c) 2021, A B\nAll rights reserved.\n\n" + files["BSD-3-Clause"])]
    filled = files["Apache-2.0"].replace("[yyyy] [name of copyright owner]", "2020 A B")
    cases += [("Apache-2.0", filled), ("Apache-2.0", files["Apache-2.0"].split("   APPENDIX:")[0]), (None, "MIT License"), (None, given["Unlicense"][:300])]
    assert set(files) == {"Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "MPL-2.0"} | {f"{x}-only" for x in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0")}
    assert "recognize copyright laws" in given["Unlicense"] and "unlicense.org" in given["Unlicense"]
    frame = spark.createDataFrame(list(enumerate(t for _, t in cases)), "doc_id long, text string")
    found = {r.doc_id: r.license for r in license_scan.scan(frame).collect()}
    assert [found[i] for i in range(len(cases))] == [k for k, _ in cases]


def test_chain_is_best():
    rng = random.Random(8)
    for _ in range(60):
        x = np.array(sorted(rng.randrange(60) for _ in range(12)))
        y = np.array([rng.randrange(60) for _ in range(12)])
        order = np.lexsort((y, x))
        x, y = x[order], y[order]
        best = [5.0] * 12
        for i in range(12):
            for j in range(i):
                if x[j] < x[i] and y[j] < y[i]:
                    best[i] = max(best[i], best[j] + 5 - substring_dedup.GAP_COST * (x[i] - x[j] + y[i] - y[j]))
        chain = substring_dedup.best_chain(x, y)
        assert all(x[a] < x[b] and y[a] < y[b] for a, b in zip(chain, chain[1:], strict=False))
        score = 5 * len(chain) - substring_dedup.GAP_COST * (x[chain[-1]] - x[chain[0]] + y[chain[-1]] - y[chain[0]])
        assert math.isclose(score, max(best))


def test_common_subsequence():
    rng = np.random.default_rng(1)
    for _ in range(40):
        a, b = rng.integers(0, 4, rng.integers(0, 12)), rng.integers(0, 4, rng.integers(0, 12))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
        assert substring_dedup.common(a, b) == table[-1, -1]


def test_substring_dedup(spark, docs, empty):
    rng = random.Random(6)
    text = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    exact, fuzzy = text(70), text(90)
    edited = [w if i % 15 else "changed" for i, w in enumerate(fuzzy)]
    texts = [text(40) + exact + text(10), text(5) + exact, exact + text(300), text(50) + fuzzy + text(20), text(10) + edited + text(60), text(200), exact[:30] + text(90)]
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    found = substring_dedup.shared_passages(frame).collect()
    assert {r.doc_id for r in found} == {0, 1, 2, 3, 4}
    assert {(r.doc_id, r.start, r.length) for r in found if r.doc_id < 3} == {(0, 40, 70), (1, 5, 70), (2, 0, 70)}
    assert all(r.similarity >= 0.8 and min(r.length, r.other_length) >= 50 and r.doc_id != r.other_id for r in found)
    assert substring_dedup.shared_passages(empty).count() == 0
    assert {r.doc_id for r in substring_dedup.shared_passages(docs).collect()} >= {i for i in (12, 13) if len((base_texts()[i] or "").split()) >= 50}


@pytest.mark.parametrize("spread", [1, 20])
def test_substring_dedup_beyond_hubs(spark, spread):
    """Two texts share 60 words whose parts all stand in texts before and after them, in few or in many."""
    rng = random.Random(7)
    text = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    low = [f"v{rng.randrange(3)}" for _ in range(60)]
    for passage in (text(60), low):
        parts = [text(20) + passage[i : i + 20] + text(20) for i in range(0, 41, 5) for _ in range(spread)]
        texts = parts + [text(30) + passage + text(10), text(10) + passage + text(40)] + parts
        frame = spark.createDataFrame([(i, " ".join(t) + f" end{i}") for i, t in enumerate(texts)], "doc_id long, text string")
        a, b = len(parts), len(parts) + 1
        found = [r for r in substring_dedup.shared_passages(frame).collect() if {r.doc_id, r.other_id} == {a, b}]
        assert {(r.doc_id, r.start, r.length) for r in found} == {(a, 30, 60), (b, 10, 60)}


def test_substring_dedup_finds_dense_edits(spark):
    """Runs of seven equal words between edits: fewer than a sampled seed needs, more than a seed."""
    rng = random.Random(8)
    text = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    rows = []
    for i in range(20):
        passage = text(60)
        edited = [w if (k + i) % 8 else f"changed{i}x{k}" for k, w in enumerate(passage)]
        rows += [(2 * i, " ".join(text(30) + passage + text(9))), (2 * i + 1, " ".join(text(5) + edited + text(50)))]
    found = substring_dedup.shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.other_id) for r in found} == {(2 * i + k, 2 * i + 1 - k) for i in range(20) for k in (0, 1)}
    assert all(50 <= r.length <= 62 for r in found)


def test_substring_dedup_members_and_text_ids(spark):
    """Copies are members of the text with the least id; ids may be text, and one id may have two texts."""
    rng = random.Random(9)
    text = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    a, passage, short = text(70), text(55), text(30)
    rows = [("k1", a), ("k2", a), ("k3", a), ("k2", passage + " " + text(9)), ("k5", text(9) + " " + passage), ("k6", short), ("k7", short), (None, a), ("k8", None)]
    found = substring_dedup.shared_passages(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert {(r.doc_id, r.start, r.length, r.other_id) for r in found} == {("k1", 0, 70, "k3"), ("k2", 0, 70, "k1"), ("k3", 0, 70, "k1"), ("k2", 0, 55, "k5"), ("k5", 9, 55, "k2")}


def test_substring_dedup_recall(spark):
    """Passages of 60 words with words replaced at random, 5 and 10 % of them: what is similar enough is found."""
    rng = random.Random(10)
    text = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    for share, least in ((0.05, 0.98), (0.1, 0.9)):
        rows, wanted = [], set()
        for i in range(100):
            passage = text(60)
            edited = [w if rng.random() >= share else f"e{i}x{k}" for k, w in enumerate(passage)]
            rows += [(2 * i, " ".join(text(30) + passage + text(9))), (2 * i + 1, " ".join(text(5) + edited + text(50)))]
            if sum(a == b for a, b in zip(passage, edited, strict=True)) >= 50:
                wanted.add(2 * i)
        found = {r.doc_id for r in substring_dedup.shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect() if abs(r.other_id - r.doc_id) == 1}
        assert len(wanted & found) >= least * len(wanted), (share, len(wanted), len(wanted & found))


def test_substring_dedup_short_runs_are_not_filled_up(spark):
    """Edits that lie at one end: the passage goes on over them.  45 equal words and none after them are no passage."""
    rng = random.Random(11)
    text = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passage, run = text(60), text(45)
    edited = [w if k < 46 or k % 3 == 2 else f"e{k}" for k, w in enumerate(passage)]
    rows = [text(20) + passage + text(20), text(9) + edited + text(9), text(20) + run + text(20), text(9) + run + text(30)]
    found = substring_dedup.shared_passages(spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(rows)], "doc_id long, text string")).collect()
    assert {(r.doc_id, r.other_id, r.start) for r in found} == {(0, 1, 20), (1, 0, 9)}
    assert all(r.length >= 50 and r.similarity >= 0.8 for r in found)


@pytest.mark.parametrize("others", [20, 60])
def test_substring_dedup_similar_passages_of_common_words(spark, others):
    """Similar passages without 50 equal words in a row, all of whose equal runs also stand in many other texts."""
    rng = random.Random(12)
    text = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    texts: list[list[str]] = []
    for i in range(10):
        passage = text(60)
        edited = [w if k % 12 != 11 else f"e{i}x{k}" for k, w in enumerate(passage)]
        texts += [text(30) + passage + text(9), text(5) + edited + text(50)]
        passages = [passage[k : k + 11] for k in range(0, 60, 12)]
        texts += [text(20) + run + text(20) for run in passages for _ in range(others)]
    order = list(range(len(texts)))
    rng.shuffle(order)
    frame = spark.createDataFrame([(order[i], " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    found = {(r.doc_id, r.other_id) for r in substring_dedup.shared_passages(frame).collect()}
    step = 2 + 5 * others
    assert found == {(order[i * step + k], order[i * step + 1 - k]) for i in range(10) for k in (0, 1)}


def test_substring_dedup_pairs_of_repeated_words():
    """A word repeated n times gives few pairs of seeds, not one for each distance; keys of no interest are left out before that."""
    words = np.full(2000, 7, np.uint64)
    seed, at = substring_dedup.seed_places(words, np.array([0, 2000]), substring_dedup.K, substring_dedup.WINDOW)
    seed, text = seed.view(np.int64), np.zeros(len(at), np.int64)
    key, first, gap = substring_dedup.seed_couples(seed, text, at)
    assert len(set(key.tolist())) == 1 and len(key) <= 5 * (2000 // substring_dedup.PAIR_APART + 1)
    assert {g // substring_dedup.PAIR_SHIFT for g in gap.tolist()} == {1, 2, 3, 4}
    assert all(len(c) == len(key) for c in substring_dedup.seed_couples(seed, text, at, np.unique(key)))
    assert not any(len(c) for c in substring_dedup.seed_couples(seed, text, at, np.unique(key) + 1))


def test_substring_dedup_runs_of_one_word(spark):
    """A text of one word over and over, and one of shorter runs of it, of which many others have one: both are linked, the others are not."""
    rng = random.Random(13)
    text = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    runs = [w for k in range(4) for w in [*["the"] * 30, f"x{k}"]]
    texts = [text(20) + ["the"] * 400 + text(20), text(60) + runs + text(30), *(text(40) + ["the"] * 25 + text(40) for _ in range(40))]
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    found = substring_dedup.shared_passages(frame).collect()
    assert {(r.doc_id, r.other_id) for r in found} == {(0, 1), (1, 0)}
    assert all(r.similarity >= 0.8 and min(r.length, r.other_length) >= 50 for r in found)


def test_operators_take_text_ids_and_odd_columns(spark, tokenizer_path):
    """Ids that are text, white-space texts, and columns named like those that operators make."""
    rows = [("a", "one two three four five", 1, 2), ("b", " \t\n", 1, 2), ("c", None, 1, 2)]
    frame = spark.createDataFrame(rows, "doc_id string, text string, `__bad` int, id int")
    marks = spark.createDataFrame([("a", 1, 1), ("b", 0, 0)], "doc_id string, quality int, toxic int")
    bench = spark.createDataFrame([("i", "one two three four five")], "item_id string, text string")
    from pyspark.sql import functions as F

    assert {r.doc_id for r in toxicity.score(frame, marks).collect()} == {"a", "b", "c"}
    assert {r.doc_id: r.tail_probability for r in quality_classifier.rate(frame, marks, F.col("quality")).collect()}["b"] == 0
    assert [(r.doc_id, r.item_id) for r in decontamination.contaminated(frame, bench).collect()] == [("a", "i")]
    kept = decontamination.drop_contaminated(frame, bench)
    assert kept.columns == frame.columns and {r.doc_id for r in kept.collect()} == {"b", "c"}
    assert {r.doc_id for r in packing.pack(frame, "doc_id", "text", tokenizer_path).collect()} == {"a", "b", "c"}
    assert line_dedup.drop_repeated(frame).columns == frame.columns


def test_scratch_is_cleared(spark, tmp_path):
    from tidemark.llm.shared import cut, scratch, shared_dir, stage

    frame = spark.range(5)
    with scratch(spark):
        one, two = cut(frame), stage(frame)
        files = [two.inputFiles()[0], one._jdf.queryExecution().logical().rdd().getCheckpointFile().get()]
        assert one.count() == two.count() == 5 and shared_dir(spark)
    gone = lambda f: not (lambda p: p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))(spark._jvm.org.apache.hadoop.fs.Path(f))
    assert all(map(gone, files))


@pytest.mark.parametrize(("module", "one", "other"), [(quality_classifier, "abcabdab", "abdabcab"), (toxicity, "abefcabefdabef", "abefdabefcabef")])
def test_longest_ngrams_tell_words_apart(module, one, other):
    """The shorter n-grams of both words are the same."""
    bags = [Counter(subwords.ngrams([w], module.SIZES, module.BITS)[0].tolist()) for w in (one, other)]
    shorter = [Counter(subwords.ngrams([w], module.SIZES[:-1], module.BITS)[0].tolist()) for w in (one, other)]
    assert shorter[0] == shorter[1] and bags[0] != bags[1]


def labelled(n=400):
    rng = random.Random(11)
    clean = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(200)]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(clean) for _ in range(rng.randint(20, 80))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(1 + len(words) // 20):
                words.insert(rng.randrange(len(words)), rng.choice(["zzxqviper", "zzxqvipers", "uzzxqviper"]))
        poor = i % 7 == 0
        rows.append((i, " ".join(w + "###" if poor else w for w in words)))
        labels.append((i, 0 if poor else 1, int(toxic)))
    return rows, labels


def test_toxicity(spark, docs, empty):
    rows, labels = labelled()
    rows += [(1000, "some of the zzxqvyper zzxqviper kind " * 3), (1001, None), (1002, ""), (1002, "")]
    frame, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = toxicity.score(frame, marks).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)
    truth = {i: y for i, _, y in labels}
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    assert next(r.score for r in found if r.doc_id == 1000) > 0.5
    assert toxicity.score(empty, marks).count() == 0
    assert {r.score for r in toxicity.score(docs, marks.limit(0)).collect()} != set()
    flipped = marks.selectExpr("doc_id", "quality", "case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 then 1 - toxic else toxic end as toxic")
    assert sorted(toxicity.score(frame, flipped).collect()) == sorted(found)  # held-out labels are never read


def test_quality_classifier(spark, docs, empty):
    rows, labels = labelled()
    rows += [(1001, None), (1002, "")]
    frame, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    from pyspark.sql import functions as F

    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    found = {r.doc_id: r for r in quality_classifier.rate(frame, marks, grade, floor=1).collect()}
    assert np.mean([found[i].kept == (q == 1) for i, q, _ in labels]) > 0.97
    assert np.mean([found[i].expected_grade for i, q, t in labels if q and not t]) > np.mean([found[i].expected_grade for i, q, t in labels if q and t])
    assert found[1001].expected_grade == 0 and not found[1002].kept
    assert quality_classifier.rate(empty, marks, grade).count() == 0
    assert quality_classifier.rate(docs, marks.limit(0), grade).count() == docs.count()


def test_thresholds_are_ordered():
    rng = np.random.default_rng(0)
    grade = rng.integers(0, 4, 200)
    texts = pa.array([" ".join(["good" if rng.random() < g / 3 else "poor" for _ in range(30)]) for g in grade])
    model = quality_classifier.train(texts, grade)
    assert (np.diff(model.thresholds) > 0).all()
    tails, some = model.tails(texts)
    assert some.all()
    assert (np.diff(tails, axis=1) <= 0).all() and np.corrcoef(tails.sum(1), grade)[0, 1] > 0.7
