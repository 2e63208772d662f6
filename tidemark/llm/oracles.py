"""DuckDB SQL for the operators that SQL can express on whole tables."""

from __future__ import annotations

from tidemark.llm.license_scan import KNOWN, SPELLINGS
from tidemark.llm.line_dedup import LONG_WORDS, MIN_LINES
from tidemark.llm.quality_rules import FEATURES, MIN_ROWS, MIN_WORDS, SPREAD

SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def sharding(shards: int = 40) -> str:
    cost = "-ln((CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR) || ':' || CAST({s} AS VARCHAR)), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0)"
    one = cost.format(s="s")
    return f"""
WITH crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
bytes AS (SELECT doc_id, text, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT)) AS b FROM documents),
summed AS (SELECT doc_id, len(b) + 16 AS size, xor(list_reduce(list_concat([4294967295], b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32 FROM bytes, crc),
placed AS (SELECT doc_id, size, text_crc32, (SELECT min(struct_pack(cost := {one}, shard := s)) FROM range({shards}) r(s)) AS won FROM summed),
dealt AS (SELECT *, CAST(won.shard AS INTEGER) AS shard FROM placed)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32, size) - 1 AS slot,
  CAST(CASE WHEN {cost.format(s=shards)} < won.cost THEN {shards} ELSE shard END AS INTEGER) AS grown_shard FROM dealt"""


def line_dedup() -> str:
    ahead = ", ".join(f"lead(t, {i}) OVER w AS t{i}" for i in range(1, MIN_LINES))
    key = ", ".join(["t"] + [f"t{i}" for i in range(1, MIN_LINES)])
    whole = " AND ".join([f"t{i} IS NOT NULL" for i in range(1, MIN_LINES)]) or "true"
    return rf"""
WITH RECURSIVE lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents),
solid AS (SELECT doc_id, i, trim(line, {SPACE}) AS t, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS idx FROM lines WHERE trim(line, {SPACE}) <> ''),
windows AS (SELECT doc_id, idx, t, {ahead or '1 AS one'} FROM solid WINDOW w AS (PARTITION BY doc_id ORDER BY idx)),
copies AS (SELECT doc_id, idx FROM windows WHERE {whole} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY doc_id, idx) > 1),
alone AS (SELECT doc_id, i FROM solid WHERE len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) >= {LONG_WORDS} QUALIFY row_number() OVER (PARTITION BY t ORDER BY doc_id, idx) > 1),
gone AS (SELECT DISTINCT s.doc_id, s.i FROM copies c, range({MIN_LINES}) r(k), solid s WHERE s.doc_id = c.doc_id AND s.idx = c.idx + k UNION SELECT doc_id, i FROM alone),
lists AS (SELECT doc_id, count(*) AS n, string_agg(CAST(i AS VARCHAR), ',' ORDER BY i) AS removed FROM gone GROUP BY doc_id),
kept AS (SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.i) AS text FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i WHERE g.i IS NULL GROUP BY l.doc_id),
runs AS (SELECT doc_id, idx, 1 AS len, md5(t) AS k FROM solid QUALIFY count(*) OVER (PARTITION BY t) > 1
  UNION ALL SELECT doc_id, idx, len, k FROM (SELECT r.doc_id, r.idx, r.len + 1 AS len, md5(r.k || s.t) AS k, count(*) OVER (PARTITION BY md5(r.k || s.t)) AS c
    FROM runs r JOIN solid s ON s.doc_id = r.doc_id AND s.idx = r.idx + r.len) WHERE c > 1),
longest AS (SELECT doc_id, max(len) AS longest_run FROM runs GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_removed, coalesce(removed, '') AS removed_lines, CASE WHEN d.text IS NOT NULL THEN md5(coalesce(k.text, '')) END AS kept_md5,
  CAST(coalesce(longest_run, 0) AS BIGINT) AS longest_run
FROM documents d LEFT JOIN lists USING (doc_id) LEFT JOIN kept k USING (doc_id) LEFT JOIN longest USING (doc_id)"""


def license_scan() -> str:
    def canonical(text: str) -> str:
        mark = r"(?m)^[ \t/*#;.-]*(?:copyright|\(c\)|©)[ \t]+(?:\(c\)|©|[0-9]|by\b)[^\n]*$"
        out = f"regexp_replace(lower({text}), '{mark}', ' ', 'g')"
        out = rf"regexp_replace({out}, '\ball rights reserved\b\.?', ' ', 'g')"
        out = rf"trim(regexp_replace({out}, '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
        for old, new in SPELLINGS:
            out = f"replace({out}, '{old}', '{new}')"
        return out

    known = ", ".join("('{}', '{}')".format(i, t.replace("'", "''")) for i, t in KNOWN)
    digest = lambda t: f"CASE WHEN {canonical(t)} <> '' THEN sha256({canonical(t)}) END"
    return f"""
WITH known AS (SELECT d AS digest, min(license) AS license FROM (SELECT license, {digest('t')} AS d FROM (VALUES {known}) v(license, t)) WHERE d IS NOT NULL GROUP BY d),
whole AS (SELECT doc_id, {digest("coalesce(text, '')")} AS digest FROM documents),
lines AS (SELECT doc_id, unnest(list_distinct(string_split(coalesce(text, ''), chr(10)))) AS line FROM documents),
notices AS (SELECT doc_id, list_sort(list_distinct(list(license))) AS notices FROM (SELECT doc_id, {digest('line')} AS digest FROM lines) JOIN known USING (digest) GROUP BY doc_id)
SELECT doc_id, digest, license, coalesce(notices, []) AS notices FROM whole LEFT JOIN known USING (digest) LEFT JOIN notices USING (doc_id)"""


def jaccard_join(n: int = 3, percent: int = 90) -> str:
    lowered = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all({lowered}, '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, g FROM (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {n} THEN [list_aggregate(w, 'string_agg', ' ')]
  ELSE list_transform(range(1, len(w) - {n - 2}), lambda i: list_aggregate(w[i : i + {n - 1}], 'string_agg', ' ')) END) AS g FROM words)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared >= {percent} * (x.n + y.n - shared)),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, b FROM reach r JOIN links ON a = r.other)
SELECT doc_id, coalesce(n, 0) AS n_shingles, (SELECT min(other) FROM reach r WHERE r.doc_id = d.doc_id) AS component_id, (SELECT count(*) FROM links WHERE a = d.doc_id) AS n_links
FROM documents d LEFT JOIN sizes USING (doc_id)"""


def quality_rules() -> str:
    floor = " ".join(f"WHEN '{f}' THEN {least}" for f, (_, least, _) in FEATURES.items())
    buckets = {
        "symbols": "least(4000, n_symbols * 1000 // greatest(n_words, 1))",
        "repeats": "least(1000, n_repeat_words * 1000 // greatest(n_words, 1))",
        "lines": "least(1000, n_dup_lines * 1000 // greatest(n_lines, 1))",
        "letters": "least(5000, word_chars * 100 // greatest(n_words, 1))",
    }
    long = " UNION ALL ".join(f"SELECT lang, source, '{f}' AS feature, {b} AS bucket FROM judged WHERE NOT base_failed" for f, b in buckets.items())

    def quantiles(by: str) -> str:
        part = f"{by}, feature" if by else "feature"
        return f"""SELECT {part}, min(bucket) FILTER (WHERE upto * 4 >= n) AS q1, min(bucket) FILTER (WHERE upto * 4 >= n * 3) AS q3, max(n) AS n FROM
          (SELECT {part}, bucket, sum(c) OVER (PARTITION BY {part} ORDER BY bucket) AS upto, sum(c) OVER (PARTITION BY {part}) AS n FROM
            (SELECT {part}, bucket, count(*) AS c FROM long GROUP BY {part}, bucket)) GROUP BY {part}"""

    fence = lambda f: f"(SELECT {{}} FROM fences x WHERE x.lang = j.lang AND x.source = j.source AND x.feature = '{f}')"
    good = " AND ".join(
        [f"coalesce({b} <= {fence(f).format('q3 + reach')}, true)" for f, b in buckets.items()]
        + [f"coalesce({buckets[f]} >= {fence(f).format('q1 - reach')}, true)" for f, (_, _, low) in FEATURES.items() if low]
    )
    return rf"""
WITH words AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
spots AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g FROM words WHERE len(w) > 2),
twice AS (SELECT doc_id, i FROM spots QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
repeats AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(3) r(k) GROUP BY doc_id),
lines AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM words),
counted AS (SELECT doc_id, lang, source, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, len(l) AS n_lines
  FROM words JOIN lines USING (doc_id) LEFT JOIN repeats r USING (doc_id)),
judged AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted),
long AS ({long}),
fine AS ({quantiles("lang, source")}), mid AS ({quantiles("lang")}), coarse AS ({quantiles("")}),
fences AS (SELECT lang, source, feature, q1, q3, {SPREAD} * greatest(q3 - q1, CASE feature {floor} END) AS reach FROM (
  SELECT g.lang, g.source, c.feature, CASE WHEN f.n >= {MIN_ROWS} THEN f.q1 WHEN m.n >= {MIN_ROWS} THEN m.q1 ELSE c.q1 END AS q1,
    CASE WHEN f.n >= {MIN_ROWS} THEN f.q3 WHEN m.n >= {MIN_ROWS} THEN m.q3 ELSE c.q3 END AS q3
  FROM (SELECT DISTINCT lang, source FROM counted) g CROSS JOIN coarse c LEFT JOIN fine f ON f.lang = g.lang AND f.source = g.source AND f.feature = c.feature
  LEFT JOIN mid m ON m.lang = g.lang AND m.feature = c.feature))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {good} AS kept FROM judged j"""


def all_sql() -> dict[str, str]:
    return {
        "op1_rendezvous_sharding": sharding(),
        "op4_line_dedup": line_dedup(),
        "op8_license_scan": license_scan(),
        "op9_jaccard_join": jaccard_join(),
        "op10_quality_rules": quality_rules(),
    }
