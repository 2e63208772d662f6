"""The change stream: micro-batches of a change log applied to mirrored tables.

A change log has one row per row change or DDL statement, in the order ``seq``:

    seq, file, pos, gtid, db, tbl, kind (insert, update, delete, ddl), before, after, ddl_sql

``before`` and ``after`` are JSON objects of column values.  A batch is cut at its DDL rows:
changes before one are applied under the old columns, then the DDL, then the rest.  Tables
of one segment are applied a few at a time, each as one fold.  Every commit carries the
stream's position, so a batch that is delivered again changes nothing: rows and schema
changes up to a table's position are left out, those up to its snapshot's position too, and
a dropped table remembers where it was dropped.  Rows of an unknown kind are counted, logged
and skipped.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import ddl
from tidemark.functions.source_types import Mode, spark_type
from tidemark.operators.apply import DELETE, OP, PUT, SEQ, changes, updates
from tidemark.operators.store import Catalog, add_gtid, merged
from tidemark.sources.config import Scope

log = logging.getLogger("tidemark")

CHANGELOG = T.StructType([
    T.StructField(name, T.LongType() if name in ("seq", "pos") else T.StringType())
    for name in ("seq", "file", "pos", "gtid", "db", "tbl", "kind", "before", "after", "ddl_sql")
])


#: Kinds of row changes.
KINDS = ("insert", "update", "delete")
#: Tables of one segment that are applied side by side.
TABLES_AT_ONCE = 4
#: Rows of a batch that the debug log shows, and characters of each.
LOGGED_ROWS = 20
LOGGED_CHARACTERS = 200


@dataclass
class Applier:
    """Applies batches of a change log; ``lookup`` gives a table's definition where DDL text does not."""

    catalog: Catalog
    scope: Scope
    mode: Mode = "safe"
    lookup: Callable[[str, str], tuple[T.StructType, tuple[str, ...]] | None] | None = None

    def __call__(self, batch: DataFrame, number: int) -> None:
        self.run(batch, number)

    def run(self, batch: DataFrame, number: int | None = None) -> int:
        """Apply one batch and return the number of row changes in scope."""
        batch = batch.persist()
        try:
            statements = batch.where("kind = 'ddl'").orderBy("seq").collect()  # schema changes are rare
            odd = batch.where(~F.coalesce(F.col("kind").isin("ddl", *KINDS), F.lit(False))).count()
            if odd:
                log.warning("%d changes of an unknown kind are skipped", odd)
            rows, since = 0, None
            for statement in [*statements, None]:
                segment = batch.where(F.col("kind").isin(*KINDS))
                segment = segment if since is None else segment.where(F.col("seq") > since)
                segment = segment if statement is None else segment.where(F.col("seq") < statement.seq)
                rows += self._segment(segment, number, len(statements), since)
                if statement is not None:
                    since = statement.seq
                    self._ddl(statement, number)
            log.info("batch %s: %d row changes applied", "-" if number is None else number, rows)
            if log.isEnabledFor(logging.DEBUG):
                for r in batch.orderBy("seq").limit(LOGGED_ROWS).collect():
                    log.debug("%s %s.%s %s", r.kind, r.db, r.tbl, (r.ddl_sql or r.after or r.before or "")[:LOGGED_CHARACTERS])
            return rows
        finally:
            batch.unpersist()

    def _segment(self, segment: DataFrame, number: int | None, statements: int, since: int | None) -> int:
        inside = segment.where(self.scope.column(F.col("db"), F.col("tbl")))
        at = F.max_by(F.struct("file", "pos"), "seq")
        ends = inside.groupBy("db", "tbl").agg(F.count(F.lit(1)).alias("n"), F.max("seq").alias("seq"), at.alias("at")).orderBy("db", "tbl").collect()  # one row a table
        if not ends:
            return 0
        passed = transactions(segment)

        def one(r) -> int:
            table = self._table(r.db, r.tbl, r.seq)
            if table is None:
                return 0
            if table.position and table.position.get("seq") is not None and r.seq <= table.position["seq"]:
                return 0  # delivered before
            position = {"file": r["at"]["file"], "pos": r["at"]["pos"], "gtid": add_gtid((table.position or {}).get("gtid") or "", passed), "seq": r.seq}
            known = (table.position or {}).get("seq")
            own = inside.where((F.col("db") == r.db) & (F.col("tbl") == r.tbl))
            own = own if known is None else own.where(F.col("seq") > known)
            own = own.where(~in_base((table.position or {}).get("base")))
            self.catalog.apply(r.db, r.tbl, self.folded_input(own, table.struct, table.key), position)
            return r.n

        with ThreadPoolExecutor(max_workers=min(len(ends), TABLES_AT_ONCE)) as pool:  # tables do not depend on each other
            return sum(pool.map(one, ends))

    def _table(self, db: str, tbl: str, seq: int):
        last = self.catalog.last(db, tbl)
        if last is not None and last.dropped and ((last.position or {}).get("ddl") or [-1, 0])[0] >= seq:
            return None  # dropped or renamed later in the stream
        found = None if last is None or last.dropped else last
        if found is None and self.lookup is not None and (known := self.lookup(db, tbl)) is not None and known[1]:
            return self.catalog.create(db, tbl, *known)
        if found is None:
            log.warning("%s.%s is unknown or has no primary key; its changes are skipped", db, tbl)
        return found

    def folded_input(self, rows: DataFrame, struct: T.StructType, key: tuple[str, ...]) -> DataFrame:
        """Typed changes of one table.  A delete needs the key of its before image only."""
        loose = T.StructType([T.StructField(f.name, f.dataType, True) for f in struct.fields])
        typed = rows.select("seq", "kind", F.from_json("before", loose).alias("before"), F.from_json("after", loose).alias("after"))
        columns = [f.name for f in struct.fields]
        image = lambda s: [F.col(f"{s}.`{c}`").alias(c) for c in columns]
        puts = changes(typed.where("kind = 'insert'").select(*image("after"), F.col("seq").alias("__at")), PUT, "__at", 1).drop("__at")
        gone = changes(typed.where("kind = 'delete'").select(*image("before"), F.col("seq").alias("__at")), DELETE, "__at", 1).drop("__at")
        moved = updates(typed.where("kind = 'update'").withColumnRenamed("seq", "__at"), columns, key, "before", "after", "__at", self.mode == "safe")
        return puts.unionByName(gone).unionByName(moved).select(*[F.col(f"`{c}`") for c in columns], SEQ, OP)

    def _ddl(self, statement, number: int | None) -> None:
        for place, change in enumerate(ddl.parse(statement.ddl_sql, statement.db or "", self.mode) or []):
            if change.kind == ddl.OTHER or not self.scope.has(change.schema, change.table):
                continue
            here = [statement.seq, place]
            last = self.catalog.last(change.schema, change.table)
            known = (last.position if last is not None else None) or {}
            if (known.get("ddl") or [-1, 0]) >= here or (known.get("seq") is not None and known["seq"] > statement.seq):
                continue  # delivered before, or the table was dropped later
            if passed_by(known.get("base"), statement.gtid, statement.file, statement.pos):
                continue  # the snapshot was taken after it
            table = None if last is None or last.dropped else last
            made = self._change(change, statement.ddl_sql, table, {"ddl": here})
            if made is not None:
                # A schema change is a version of its own; its place in the stream is kept so that it happens once.
                position = merged(made.position, dict(made.position or {}) | {"ddl": here})
                self.catalog.commit(made.__class__(**made.__dict__ | {"position": position}), made.schema, made.table)

    def _change(self, change: ddl.Change, sql: str, table, position: dict):
        c = self.catalog
        if change.kind == ddl.CREATE:
            if table is not None:
                return None
            try:
                columns, key = ddl.create_columns(sql)
                struct = T.StructType([T.StructField(x.name, spark_type(x.type, self.mode), x.nullable) for x in columns])
            except ValueError:
                known = self.lookup(change.schema, change.table) if self.lookup else None
                if known is None:
                    return None
                struct, key = known
            return c.create(change.schema, change.table, struct, key) if key else None
        if table is None:
            return None
        if change.kind == ddl.DROP:
            c.drop(change.schema, change.table, dict(table.position or {}) | position)
        elif change.kind == ddl.TRUNCATE:
            return c.truncate(change.schema, change.table)
        elif change.kind == ddl.RENAME:
            if change.new_schema != change.schema:
                log.warning("a table is not moved between schemas: %s", sql)
                return None
            c.rename(change.schema, change.table, change.new_table, dict(table.position or {}) | position)
            return None
        elif change.kind == ddl.ADD:
            return c.add_column(change.schema, change.table, change.column, spark_type(change.type, self.mode)) if change.column not in table.columns else None
        elif change.kind == ddl.REMOVE:
            return c.drop_column(change.schema, change.table, change.column) if change.column in table.columns else None
        return None


def start_mode(position: dict | None) -> str:
    """How to begin: from a transaction set, from a file position, or with a snapshot."""
    if position and position.get("gtid"):
        return "gtid"
    return "file" if position and position.get("file") else "snapshot"


def stream(spark: SparkSession, folder: str, applier: Applier, checkpoint: str, form: str = "json", follow: bool = False):
    """A query over files of change log rows: it applies what is there and stops, or goes on with what comes."""
    source = spark.readStream.schema(CHANGELOG).format(form).load(folder)
    writer = source.writeStream.foreachBatch(applier).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime="1 second") if follow else writer.trigger(availableNow=True)).start()


def transactions(rows: DataFrame) -> str:
    """The transaction set of change log rows.

    Numbers are gathered by server and thousands, so that what reaches the driver is a range
    for each run of them.
    """
    parts = rows.where("gtid <> ''").select(F.lower(F.substring_index("gtid", ":", 1)).alias("server"), F.substring_index("gtid", ":", -1).cast("long").alias("n")).where("n is not null")
    held = parts.groupBy("server", F.floor(F.col("n") / 1024).alias("part")).agg(F.min("n").alias("a"), F.max("n").alias("b"), F.collect_set("n").alias("all"))  # at most 1024 each
    whole = F.size("all") == F.col("b") - F.col("a") + 1
    spans = held.select("server", F.when(whole, F.concat_ws("-", "a", "b")).otherwise(F.concat_ws(":", F.transform(F.sort_array("all"), lambda n: n.cast("string")))).alias("span"))
    by_server: dict[str, list[str]] = {}
    for r in spans.collect():
        by_server.setdefault(r.server, []).append(r.span)
    return ",".join(":".join([server, *found]) for server, found in sorted(by_server.items()))


def _spans(gtid: str) -> list[tuple[str, int, int]]:
    return [(server, int(r.partition("-")[0]), int(r.partition("-")[2] or r.partition("-")[0])) for part in gtid.split(",") if part for server, *ranges in [part.split(":")] for r in ranges]


def in_base(base: dict | None):
    """Whether a change log row is part of the snapshot with this position, as a column."""
    if not base:
        return F.lit(False)
    if base.get("gtid"):
        server, n = F.lower(F.substring_index("gtid", ":", 1)), F.substring_index("gtid", ":", -1).cast("long")
        inside = F.lit(False)
        for name, low, high in _spans(add_gtid(base["gtid"], "")):
            inside |= (server == name) & n.between(low, high)
        return F.coalesce(inside, F.lit(False))
    if base.get("file"):
        return F.coalesce((F.col("file") < base["file"]) | ((F.col("file") == base["file"]) & (F.col("pos") <= int(base.get("pos") or 0))), F.lit(False))
    return F.lit(False)


def passed_by(base: dict | None, gtid: str | None, file: str | None, pos: int | None) -> bool:
    """The same for one statement."""
    if not base:
        return False
    if base.get("gtid"):
        server, _, n = (gtid or "").lower().rpartition(":")
        return n.isdigit() and any(server == name and low <= int(n) <= high for name, low, high in _spans(add_gtid(base["gtid"], "")))
    return bool(base.get("file")) and file is not None and pos is not None and (file, pos) <= (base["file"], int(base.get("pos") or 0))


def batches(log_rows: DataFrame, cuts: list[int]) -> Iterator[DataFrame]:
    """A change log cut at sequence numbers, for replays."""
    low = None
    for high in [*cuts, None]:
        part = log_rows if low is None else log_rows.where(F.col("seq") > low)
        yield part if high is None else part.where(F.col("seq") <= high)
        low = high
