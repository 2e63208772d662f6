"""Source column types to Spark types.

``reference`` mode keeps the widths of the mirror this engine replaces, hazards included;
``safe`` widens where values would not fit: unsigned integers, and decimals beyond 38 digits.
"""

from __future__ import annotations

import re
from typing import Literal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

Mode = Literal["reference", "safe"]

#: Prefixes of the first word of a type and the target's name, first match wins.
PREFIXES = (
    ("smallint", "SMALLINT"),
    ("mediumint", "INTEGER"),
    ("int", "INTEGER"),
    ("integer", "INTEGER"),
    ("bigint", "BIGINT"),
    ("decimal", "DECIMAL"),
    ("numeric", "DECIMAL"),
    ("float", "FLOAT"),
    ("double", "DOUBLE"),
    ("real", "DOUBLE"),
    ("bit", "BIGINT"),
    ("bool", "BOOLEAN"),
    ("datetime", "TIMESTAMP"),
    ("timestamp", "TIMESTAMP"),
    ("date", "DATE"),
    ("time", "TIME"),
    ("year", "INTEGER"),
    ("char", "VARCHAR"),
    ("varchar", "VARCHAR"),
    ("tinytext", "VARCHAR"),
    ("text", "VARCHAR"),
    ("mediumtext", "VARCHAR"),
    ("longtext", "VARCHAR"),
    ("json", "JSON"),
    ("binary", "BLOB"),
    ("varbinary", "BLOB"),
    ("tinyblob", "BLOB"),
    ("blob", "BLOB"),
    ("mediumblob", "BLOB"),
    ("longblob", "BLOB"),
    ("enum", "VARCHAR"),
    ("set", "VARCHAR"),
)

#: Target names and the Spark type that holds their values.
SPARK = {
    "BOOLEAN": T.BooleanType(),
    "TINYINT": T.ByteType(),
    "SMALLINT": T.ShortType(),
    "INTEGER": T.IntegerType(),
    "BIGINT": T.LongType(),
    "FLOAT": T.FloatType(),
    "DOUBLE": T.DoubleType(),
    "TIMESTAMP": T.TimestampNTZType(),
    "DATE": T.DateType(),
    "TIME": T.StringType(),  # the source's range, up to 838 hours, fits no time type
    "VARCHAR": T.StringType(),
    "JSON": T.StringType(),
    "BLOB": T.BinaryType(),
}

_EXACT_DECIMAL = re.compile(r"^(?:decimal|numeric)\((\d+),(\d+)\)")


def target_name(source: str) -> str:
    """The target's type name of a source type, as the ``reference`` mode has it."""
    text = source.strip().lower()
    if not text:
        raise ValueError("empty column type")
    word = text.split()[0].rstrip(",")
    if word.startswith("tinyint"):
        return "BOOLEAN" if "tinyint(1)" in word else "TINYINT"
    for prefix, name in PREFIXES:
        if word.startswith(prefix):
            if name == "DECIMAL":
                found = _EXACT_DECIMAL.match(word)
                return f"DECIMAL({found[1]},{found[2]})" if found else "DECIMAL(38,10)"
            return name
    return "VARCHAR"


def spark_type(source: str, mode: Mode = "safe") -> T.DataType:
    name = target_name(source)
    if name.startswith("DECIMAL"):
        if mode == "safe":
            spaced = re.match(r"(?:decimal|numeric)\s*\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)", source.strip().lower())
            p, s = (int(spaced[1]), int(spaced[2] or 0)) if spaced else (10, 0)
            if re.match(r"(?:decimal|numeric)\b", source.strip().lower()):
                return T.DecimalType(p, s) if p <= 38 else T.StringType()
        p, s = map(int, name[8:-1].split(","))
        return T.DecimalType(p, s)
    if mode == "safe" and "unsigned" in source.lower():
        wider = {"TINYINT": T.ShortType(), "SMALLINT": T.IntegerType(), "INTEGER": T.LongType(), "BIGINT": T.DecimalType(20, 0)}
        if name in wider and "mediumint" not in source.lower():
            return wider[name]
    return SPARK[name]


def target_name_column(source: Column) -> Column:
    """:func:`target_name` as a column expression (null and empty give null)."""
    text = F.lower(F.trim(source))
    word = F.rtrim(F.regexp_extract(text, r"^(\S+)", 1))
    word = F.regexp_replace(word, ",+$", "")
    out = F.when(word == "", F.lit(None).cast("string"))
    out = out.when(word.startswith("tinyint"), F.when(word.contains("tinyint(1)"), "BOOLEAN").otherwise("TINYINT"))
    exact = F.regexp_extract(word, r"^(?:decimal|numeric)(\(\d+,\d+\))", 1)
    for prefix, name in PREFIXES:
        value = F.when(exact != "", F.concat(F.lit("DECIMAL"), exact)).otherwise("DECIMAL(38,10)") if name == "DECIMAL" else F.lit(name)
        out = out.when(word.startswith(prefix), value)
    return out.when(source.isNotNull(), F.lit("VARCHAR"))


def is_integer(source: str) -> bool:
    """Whether a key of this source type can be cut into ranges."""
    return source.strip().lower().startswith(("tinyint", "smallint", "mediumint", "int", "bigint"))
