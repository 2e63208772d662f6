"""Quality rules whose thresholds adapt to each language and source, with JVM expressions only.

Each text gets counts (words, symbols, repeated lines, repeated three-word windows).  Texts
that pass the fixed base rule feed quantile sketches: histograms over integer buckets of
four features, one per (language, source).  Counts per bucket add up, so sketches merge in
any order with the same result, and those of the sources merge into one per language and
one for all.  A feature's upper fence is ``q75 + SPREAD * max(q75 - q25, floor)``; mean word
length also has the lower fence.  A group of fewer than ``MIN_ROWS`` texts takes the
language's sketch, or else that of all texts.  The fences are joined back by group.

Edge cases: a null or empty text has no words and fails the base rule; null language or
source is a group of its own; repeated rows count and stay as rows; an empty table gives no
rows; other columns pass through :func:`keep_good` untouched whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import SPACE, SPACE_CLASS, col, cut, fresh, small_enough, stage

MIN_WORDS = 50
MIN_ROWS = 200
SPREAD = 4
#: feature -> (buckets, least spread, has a lower fence); buckets are thousandths, or hundredths of a letter.
FEATURES = {"symbols": (4000, 25, False), "repeats": (1000, 75, False), "lines": (1000, 100, False), "letters": (5000, 40, True)}
#: Groups of fences that may be broadcast: under 100 bytes each, so under 20 MB.
BROADCAST_GROUPS = 200_000
NONE = "\u0000"
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_POS_BITS = 24


def _covered(ordered: Column, key_of, pos_of) -> Column:
    """Words in three-word windows whose key stands next to an equal one in the sorted array."""
    equal = lambda i, j: key_of(F.get(ordered, i)) == key_of(F.get(ordered, j))
    hit = F.filter(ordered, lambda x, i: F.coalesce(equal(i, i - 1), F.lit(False)) | F.coalesce(equal(i, i + 1), F.lit(False)))
    at = F.array_sort(F.transform(hit, pos_of))
    state = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
    return F.aggregate(at, state, lambda s, p: F.struct(p.alias("last"), (s["n"] + F.least(F.lit(3), p - s["last"])).alias("n")), lambda s: s["n"])


def with_counts(docs: DataFrame, text: str, extra: dict[str, str]) -> DataFrame:
    """``docs`` with the five counts and the number of lines, under the names given in ``extra``.

    Steps are separate projections so that each array is made once.  A window's key is 40
    bits of a hash beside 24 bits of position, so sorting is on plain longs; if two unequal
    windows ever share a key, or a text has 2^24 words, the windows' own words are sorted.
    """
    names = {k: extra.get(k) or fresh(docs, k) for k in (*COUNTS, "n_lines")}
    tmp = {k: fresh(docs, k) for k in ("words", "lines", "keys", "odd", "plain")}
    own = list(docs.columns)
    body, words, keys = F.coalesce(col(text), F.lit("")), F.col(tmp["words"]), F.col(tmp["keys"])
    trimmed = F.btrim(body, F.lit(SPACE))
    docs = docs.withColumns({
        tmp["words"]: F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS + "+")),
        tmp["lines"]: F.filter(F.split(body, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != ""),
        names["n_symbols"]: (F.char_length(body) - F.char_length(F.translate(body, SYMBOLS, ""))).cast("long"),
        names["word_chars"]: F.char_length(F.translate(body, SPACE, "")).cast("long"),
    })
    high, low = (lambda x: F.shiftright(x, _POS_BITS)), (lambda x: x.bitwiseAND((1 << _POS_BITS) - 1).cast("int"))
    last = F.size(words) - F.lit(3)
    positions = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    window = lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    docs = docs.withColumns({
        tmp["keys"]: F.sort_array(F.transform(positions, lambda i: F.shiftleft(window(i), _POS_BITS).bitwiseOR(i.cast("long")))),
        names["n_words"]: F.size(words).cast("long"),
        names["n_lines"]: F.size(tmp["lines"]).cast("long"),
        names["n_dup_lines"]: (F.size(tmp["lines"]) - F.size(F.array_distinct(F.col(tmp["lines"])))).cast("long"),
    })
    three = lambda x: F.slice(words, low(x) + 1, 3)
    neighbours = lambda x, i: F.coalesce((high(x) == high(F.get(keys, i - 1))) & (three(x) != three(F.get(keys, i - 1))), F.lit(False))
    odd = (F.size(words) >= (1 << _POS_BITS)) | (F.size(F.filter(keys, neighbours)) > 0)
    plain = F.array_sort(F.transform(positions, lambda i: F.struct(F.concat_ws(" ", F.slice(words, i + 1, 3)).alias("k"), i.alias("p"))))
    docs = docs.withColumn(tmp["odd"], odd)
    docs = docs.withColumn(tmp["plain"], F.when(F.col(tmp["odd"]), plain))
    return docs.select(
        *[col(c) for c in own],
        *[F.col(names[k]) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines")],
        F.when(F.col(tmp["odd"]), _covered(F.col(tmp["plain"]), lambda x: x["k"], lambda x: x["p"])).otherwise(_covered(keys, high, low)).cast("long").alias(names["n_repeat_words"]),
        F.col(names["n_lines"]),
    )


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (n_repeat_words * 100 > n_words * 50)


def _buckets(names: dict[str, str]) -> dict[str, Column]:
    ratio = lambda a, b, by, most: F.least(F.lit(most), F.expr(f"(`{names[a]}` * {by}) div greatest(`{names[b]}`, 1)"))
    return {
        "symbols": ratio("n_symbols", "n_words", 1000, 4000),
        "repeats": ratio("n_repeat_words", "n_words", 1000, 1000),
        "lines": ratio("n_dup_lines", "n_lines", 1000, 1000),
        "letters": ratio("word_chars", "n_words", 100, 5000),
    }


def fences(counted: DataFrame, names: dict[str, str], lang: str, source: str) -> DataFrame:
    """Per group: lang, source and the fences lo_<feature>, hi_<feature>."""
    key = lambda c: F.coalesce(col(c).cast("string"), F.lit(NONE))
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), b.cast("int").alias("bucket")) for f, b in _buckets(names).items()])
    sketch = (
        counted.where(~base_failed(col(names["n_words"]), col(names["n_repeat_words"])))
        .select(key(lang).alias("lang"), key(source).alias("source"), F.explode(pairs).alias("x"))
        .groupBy("lang", "source", "x.feature", "x.bucket")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    sketch = cut(sketch)  # groups x buckets at most, however many rows were read
    groups = counted.select(key(lang).alias("lang"), key(source).alias("source")).distinct()

    def quantiles(by: list[str]) -> DataFrame:
        merged = sketch.groupBy(*by, "feature", "bucket").agg(F.sum("n").alias("n"))
        group = Window.partitionBy(*by, "feature")
        merged = merged.select(*by, "feature", "bucket", F.sum("n").over(group.orderBy("bucket")).alias("upto"), F.sum("n").over(group).alias("rows"))
        at = lambda q: F.min(F.when(F.col("upto") * 4 >= F.col("rows") * q, F.col("bucket")))
        found = merged.groupBy(*by, "feature").agg(at(1).alias("q1"), at(3).alias("q3"), F.max("rows").alias("rows"))
        floor = F.create_map(*[F.lit(x) for f, (_, least, _) in FEATURES.items() for x in (f, least)])
        reach = F.greatest(F.col("q3") - F.col("q1"), F.element_at(floor, F.col("feature"))) * SPREAD
        one = lambda f, c: F.max(F.when(F.col("feature") == f, c))
        return (
            found.groupBy(*by)
            .agg(F.max("rows").alias("rows"), *[x for f in FEATURES for x in (one(f, F.col("q1") - reach).alias(f"lo_{f}"), one(f, F.col("q3") + reach).alias(f"hi_{f}"))])
            .withColumn("fence", F.struct(*[F.col(f"{e}_{f}") for f in FEATURES for e in ("lo", "hi")]))
            .select(*by, "rows", "fence")
        )

    fine = quantiles(["lang", "source"]).where(F.col("rows") >= MIN_ROWS).select("lang", "source", F.col("fence").alias("fine"))
    mid = quantiles(["lang"]).where(F.col("rows") >= MIN_ROWS).select("lang", F.col("fence").alias("mid"))
    coarse = quantiles([]).select(F.col("fence").alias("coarse"))
    return (
        groups.join(fine, ["lang", "source"], "left").join(mid, ["lang"], "left").join(F.broadcast(coarse), F.lit(True), "left")  # one row
        .select("lang", "source", F.coalesce("fine", "mid", "coarse").alias("fence"))
    )


def _judge(counted: DataFrame, names: dict[str, str], lang: str, source: str, failed: str, kept: str) -> DataFrame:
    """``counted`` with the columns ``failed`` and ``kept``."""
    own = [col(c) for c in counted.columns]
    limits = cut(fences(counted, names, lang, source))
    g = {k: fresh(counted, f"by_{k}") for k in ("lang", "source", "fence")}
    limits = limits.select(*[F.col(k).alias(v) for k, v in g.items()])
    if small_enough(limits, BROADCAST_GROUPS):
        limits = F.broadcast(limits)
    key = lambda c: F.coalesce(col(c).cast("string"), F.lit(NONE))
    joined = counted.join(limits, (key(lang) == F.col(g["lang"])) & (key(source) == F.col(g["source"])), "left")
    good = F.lit(True)
    for f, b in _buckets(names).items():
        fence = F.col(g["fence"])
        good &= F.coalesce(b <= fence[f"hi_{f}"], F.lit(True))
        if FEATURES[f][2]:
            good &= F.coalesce(b >= fence[f"lo_{f}"], F.lit(True))
    bad = base_failed(col(names["n_words"]), col(names["n_repeat_words"]))
    return joined.select(*own, bad.alias(failed), (~bad & good).alias(kept))


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """One row per text: doc_id, the five counts, base_failed and kept."""
    names = {k: k for k in COUNTS} | {"n_lines": "n_lines"}
    narrow = docs.select(col(doc_id).alias("doc_id"), col(lang).alias("lang"), col(source).alias("source"), col(text).alias("text"))
    counted = cut(with_counts(narrow, "text", names).drop("text"))  # the texts are read once
    judged = _judge(counted, names, "lang", "source", "base_failed", "kept")
    return judged.select(F.col("doc_id").alias(doc_id), *COUNTS, "base_failed", "kept")


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of ``docs`` that pass, with its own columns only."""
    own = [col(c) for c in docs.columns]
    names = {k: fresh(docs, k) for k in (*COUNTS, "n_lines")}
    counted = stage(with_counts(docs, text, names))
    failed, kept = fresh(counted, "failed"), fresh(counted, "kept")
    return _judge(counted, names, lang, source, failed, kept).where(F.col(kept)).select(*own)
