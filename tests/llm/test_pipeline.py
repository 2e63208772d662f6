"""The corpus pipeline and the registered queries against plain versions on the smallest tables."""

import math
import re
import zlib
from collections import Counter, defaultdict

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tidemark.llm.decontamination import question_and_answer, terms_of
from tidemark.llm.quality_rules import FEATURES, MIN_ROWS, SPREAD
from tests.llm.test_operators import counts, gone_lines, shingles


def plain_quality(docs):
    features = {}
    for d, text, lang, source in docs:
        n, chars, symbols, dup, repeats = counts(text)
        lines = len([x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\f\r")])
        failed = n < 50 or 100 * repeats > 50 * n
        made = (min(4000, symbols * 1000 // max(n, 1)), min(1000, repeats * 1000 // max(n, 1)), min(1000, dup * 1000 // max(lines, 1)), min(5000, chars * 100 // max(n, 1)))
        features[d] = (failed, dict(zip(FEATURES, made, strict=True)), lang, source)

    def fence(members, f):
        values = sorted(m[1][f] for m in members)
        at = lambda q: values[math.ceil(len(values) * q / 4) - 1]
        reach = SPREAD * max(at(3) - at(1), FEATURES[f][1])
        return at(1) - reach, at(3) + reach

    good = [m for m in features.values() if not m[0]]
    kept = []
    for d, (failed, own, lang, source) in features.items():
        fine = [m for m in good if m[2:] == (lang, source)]
        mid = [m for m in good if m[2] == lang]
        group = fine if len(fine) >= MIN_ROWS else mid if len(mid) >= MIN_ROWS else good
        inside = all(own[f] <= fence(group, f)[1] and (not FEATURES[f][2] or own[f] >= fence(group, f)[0]) for f in FEATURES)
        if not failed and inside:
            kept.append(d)
    return set(kept)


def plain_pipeline(spark, sf_dir):
    docs = [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    keep = plain_quality(docs)
    rows = [(d, t) for d, t, _, _ in docs if d in keep]
    gone = gone_lines(rows, 2)
    cut = {}
    for d, t in rows:
        text = "\n".join(x for i, x in enumerate(t.split("\n")) if i not in set(gone[d, t]))
        if not gone[d, t] or text.strip(" \t\n\x0b\f\r"):
            cut[d] = text
    sets, up = {d: shingles(t, 5) for d, t in cut.items()}, {d: d for d in cut}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    where = defaultdict(set)
    for d, s in sets.items():
        for g in s:
            where[g].add(d)
    for a in sets:
        for b, n in Counter(x for g in sets[a] for x in where[g]).items():
            if a < b and 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    left = {d: t for d, t in cut.items() if root(d) == d}
    grams = lambda w, n: {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}

    def has(text):
        words = terms_of(text)
        for _, item in bench:
            parts = [p for p in question_and_answer(item) if p]
            if parts and all(len(grams(p, min(3, len(p))) & grams(words, min(3, len(p)))) >= 0.6 * len(grams(p, min(3, len(p)))) for p in parts):
                return True
        return False

    return {d: t for d, t in left.items() if not has(t)}


def test_pipeline(spark, sf_dir):
    from tokenizers import Tokenizer

    path = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    expected = {d: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for d, t in plain_pipeline(spark, sf_dir).items()}
    found = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id: r.doc_tokens for r in found} == expected
    assert Counter(r.doc_id for r in found for _ in range(r.length)) == Counter(expected)


def test_stages_keep_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == docs.columns
        assert stage(spark, docs.limit(0), sf_dir).count() == 0


def test_toxic_and_quality_queries_are_accurate(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    toxic = entry.queries()["op3_toxicity"](spark, sf_dir).collect()
    held = [(r.score, labels[r.doc_id].toxic) for r in toxic if r.held_out and r.doc_id in labels]
    pairs = [(a > b) + 0.5 * (a == b) for a, y in held if y for b, z in held if not z]
    assert len(toxic) == 1000 and sum(pairs) / len(pairs) > 0.75
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in toxic)
    kept = {r.doc_id: r.kept for r in entry.queries()["op5_ordinal_quality"](spark, sf_dir).collect()}
    good = [kept[d] for d, r in labels.items() if r.quality]
    poor = [kept[d] for d, r in labels.items() if not r.quality]
    assert sum(good) / len(good) > 0.95 and sum(poor) / len(poor) < 0.3


def test_substring_query_finds_verbatim_runs(spark, sf_dir):
    """Every run of 60 words that two different documents share in one place is in a reported passage."""
    docs = {r.doc_id: re.findall(r"[^\x20\x09-\x0D]+", r.text.lower()) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    spots = defaultdict(set)
    for d, w in docs.items():
        for i in range(len(w) - 59):
            if len(set(w[i : i + 60])) > 30:
                spots[tuple(w[i : i + 60])].add((d, i))
    spans = defaultdict(list)
    for r in entry.queries()["op2_substring_dedup"](spark, sf_dir).collect():
        spans[r.doc_id].append((r.start, r.start + r.length))
    shared = [s for s in spots.values() if len({d for d, _ in s}) > 1]
    assert shared
    for places in shared:
        for d, i in places:
            assert any(a <= i and i + 60 <= b for a, b in spans[d])
