"""Licence scans by canonical digests, with JVM expressions only.

Entire texts and entire lines are brought to a canonical form: lower case, copyright lines
left out, equivalent spellings replaced, everything but letters and digits turned into
single spaces.  The SHA-256 of that form is joined with the digests of known licence texts
and notices.  Digests are made once per distinct unit where the join needs them: a line
that a third of all texts share is one row of the join.

Edge cases: null and empty texts, and texts of copyright lines alone, have no digest and
match nothing; repeated rows and ids each keep their row; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.shared import col, cut

#: Spellings held to be the same, wherever they stand, in the order of replacement.
SPELLINGS = (
    ("licence", "license"),
    ("sub license", "sublicense"),
    ("organisation", "organization"),
    ("authorised", "authorized"),
    ("favour", "favor"),
    ("acknowledgement", "acknowledgment"),
    ("copyright holder", "copyright owner"),
    ("non infringement", "noninfringement"),
    ("per cent", "percent"),
    ("https", "http"),
)

#: Known notices and short licence texts, by SPDX id; long texts stand in the folder licenses.
_GIVEN = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    (
        "MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "ISC",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
    ),
    (
        "Unlicense",
        """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or
as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the
detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of
all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>""",
    ),
)

#: Title lines that may stand before a text.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "Unlicense": ("Unlicense", "The Unlicense"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", 'BSD 2-Clause "Simplified" License'),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License'),
}


def _variants(name: str, text: str) -> Iterator[tuple[str, str]]:
    """The text, then the forms it is found in: below a title, without the appendix or its copyright line to fill in."""
    yield name, text
    for title in TITLES.get(name, ()):
        yield name, f"{title}\n\n{text}"
    yield name, re.sub(r"(?m)^ *Copyright (?:\[yyyy\]|\(C\) <year>) .*$", "", text)
    for end in ("END OF TERMS AND CONDITIONS\n", "APPENDIX: How to apply"):
        if end in text:
            at = text.index(end)
            yield name, text[:at]
            yield name, text[:at] + (end if end.startswith("END") else "")


def _known() -> tuple[tuple[str, str], ...]:
    files = [(f.stem, f.read_text(encoding="utf-8")) for f in sorted((Path(__file__).parent / "licenses").glob("*.txt"))]
    notices, texts = [k for k in _GIVEN if "\n" not in k[1]], [k for k in _GIVEN if "\n" in k[1]]
    return tuple(dict.fromkeys([*notices, *(v for name, text in [*texts, *files] for v in _variants(name, text))]))


#: The notices, and the whole texts in their variants.
KNOWN = _known()


def _without_copyright(text: Column) -> Column:
    """Lines that begin with a copyright mark and name a holder or year, and the phrase all rights reserved, go."""
    text = F.regexp_replace(text, r"(?m)^[ \t/*#;.-]*(?:copyright|\(c\)|©)[ \t]+(?:\(c\)|©|[0-9]|by\b)[^\n]*$", " ")
    return F.regexp_replace(text, r"\ball rights reserved\b\.?", " ")


def canonical(text: Column) -> Column:
    out = _without_copyright(F.lower(text))
    out = F.btrim(F.regexp_replace(out, r"[^\p{L}\p{N}]+", " "))
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def digest(text: Column) -> Column:
    """Null where the canonical form is empty."""
    form = canonical(text)
    return F.when(form != "", F.sha2(F.encode(form, "UTF-8"), 256))


def known_digests(spark: SparkSession, known=KNOWN) -> DataFrame:
    """Rows (digest, license): each known text, and each as one line."""
    rows = spark.createDataFrame(list(known), "license string, text string")
    return rows.select(digest(F.col("text")).alias("digest"), "license").where("digest is not null").groupBy("digest").agg(F.min("license").alias("license"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: DataFrame | None = None) -> DataFrame:
    """One row per text: id, digest, license (of the entire text), notices (sorted licences of its lines).

    ``known`` may hold any number of rows (digest, license); the join is Spark's to choose.
    """
    listed = known if known is not None else known_digests(docs.sparkSession)
    body = F.coalesce(col(text_col), F.lit(""))
    split = F.array_distinct(F.split(body, "\n"))
    lines = F.filter(F.transform(split, digest), lambda d: d.isNotNull())
    rows = cut(docs.select(col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), digest(body).alias("digest"), lines.alias("lines")))
    notices = rows.select("row", F.explode("lines").alias("digest")).join(listed, "digest").groupBy("row").agg(F.sort_array(F.collect_set("license")).alias("notices"))
    whole = rows.select("id", "row", "digest").join(listed, "digest", "left")
    return whole.join(notices, "row", "left").select(
        F.col("id").alias(id_col), "digest", "license", F.coalesce("notices", F.array().cast("array<string>")).alias("notices")
    )
