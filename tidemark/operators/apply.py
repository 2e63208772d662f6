"""Applying keyed changes: the last change of a key wins.

Every put or delete fixes the state of its key, so of a batch only the last change of each
key matters.  The fold is a partial aggregation (``max_by`` before the shuffle), so a key
with very many changes arrives as one row a partition; nothing is sorted or gathered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns of changes besides the table's own.
SEQ, OP = "__seq", "__op"
PUT, DELETE = "put", "delete"


def _name(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def changes(rows: DataFrame, op: str | Column, seq: str | Column, order: int = 0) -> DataFrame:
    """``rows`` as changes: an operation and a place in the total order (``order`` breaks ties)."""
    op = F.lit(op) if isinstance(op, str) else op
    seq = F.col(seq) if isinstance(seq, str) else seq
    return rows.withColumns({SEQ: F.struct(seq.cast("long").alias("at"), F.lit(order).alias("sub")), OP: op})


def updates(pairs: DataFrame, columns: Sequence[str], key: Sequence[str], before: str, after: str, seq: str, moved_keys: bool) -> DataFrame:
    """Updates as changes.  ``before`` and ``after`` are structs of the table's columns.

    With ``moved_keys`` an update that changes the key also deletes the old key, just before
    its put; without, the old row stays, as in the mirror this engine replaces.
    """
    image = lambda s: [F.col(f"{s}.{_name(c)}").alias(c) for c in columns]
    puts = changes(pairs.select(*image(after), seq), PUT, seq, 1).drop(seq)
    if not moved_keys:
        return puts
    same = F.lit(True)
    for k in key:
        same &= F.col(f"{before}.{_name(k)}").eqNullSafe(F.col(f"{after}.{_name(k)}"))
    gone = changes(pairs.where(~same).select(*image(before), seq), DELETE, seq, 0).drop(seq)
    return gone.unionByName(puts)


def fold(log: DataFrame, key: Sequence[str]) -> DataFrame:
    """The last change of each key, with the columns of ``log``."""
    if not key:
        raise ValueError("a table without a primary key cannot take keyed changes")
    rest = [c for c in log.columns if c not in key]
    last = log.groupBy(*map(_name, key)).agg(F.max_by(F.struct(*map(_name, rest)), SEQ).alias("__last"))
    return last.select(*[F.col(_name(c)) if c in key else F.col(f"__last.{_name(c)}").alias(c) for c in log.columns])


def apply(base: DataFrame, log: DataFrame, key: Sequence[str]) -> DataFrame:
    """``base`` after all changes of ``log``: keys that changed leave, the puts among the last changes enter.

    Deletes of missing keys do nothing; a put replaces the whole row.
    """
    last = fold(log, key)
    return apply_folded(base, last, key)


def apply_folded(base: DataFrame, last: DataFrame, key: Sequence[str]) -> DataFrame:
    puts = last.where(F.col(OP) == PUT).select(*map(_name, base.columns))
    kept = base.join(last.select(*map(_name, key)), list(key), "left_anti")
    return kept.select(*map(_name, base.columns)).unionByName(puts)


def shaped(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows by position: missing trailing columns become null, extra ones are dropped."""
    own = rows.columns[: len(columns)]
    short = [F.lit(None).alias(c) for c in columns[len(own) :]]
    return rows.select(*[F.col(_name(a)).alias(b) for a, b in zip(own, columns, strict=False)], *short)
