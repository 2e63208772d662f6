"""Sources of tables: Parquet folders or a database over JDBC, and the snapshot copy.

A source lists tables, knows their columns and keys, and reads a table as the union of key
ranges, one Spark partition each.  The snapshot copies tables side by side from a small pool
of driver threads; a table's version is committed only when all its ranges were read.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.source_types import Mode, is_integer, spark_type
from tidemark.functions.values import wall_clock_column
from tidemark.operators.apply import shaped
from tidemark.operators.ranges import Range, plan_ranges, ranges_of
from tidemark.operators.store import Catalog, Manifest
from tidemark.sources.config import Scope, Source
from tidemark.sources.progress import Watch

log = logging.getLogger("tidemark")


@dataclass(frozen=True)
class Table:
    schema: str
    name: str
    struct: T.StructType
    key: tuple[str, ...]


class TableSource(Protocol):
    def tables(self) -> list[Table]: ...

    def read(self, table: Table, ranges: Sequence[Range]) -> DataFrame: ...

    def ranges(self, table: Table, parts: int) -> list[Range]: ...

    def estimated_rows(self, table: Table) -> int: ...

    def position(self) -> dict | None: ...


class ParquetSource:
    """Tables as Parquet files ``<folder>/<name>.parquet``, with their keys given."""

    def __init__(self, spark: SparkSession, folder: str, schema: str, keys: dict[str, Sequence[str]], position: dict | None = None):
        self.spark, self.folder, self.schema, self.keys, self.at = spark, folder.rstrip("/"), schema, keys, position

    def frame(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def tables(self) -> list[Table]:
        return [Table(self.schema, name, self.frame(name).schema, tuple(key)) for name, key in sorted(self.keys.items())]

    def ranges(self, table: Table, parts: int) -> list[Range]:
        return ranges_of(self.frame(table.name), table.key, parts)

    def read(self, table: Table, ranges: Sequence[Range]) -> DataFrame:
        """One scan of the ranges: files are cut by their row groups, so ranges are a condition and not scans of their own."""
        held = F.lit(False)
        for r in ranges:
            held |= r.holds()
        whole = self.frame(table.name)
        return whole if any(r.column is None for r in ranges) else whole.where(held)

    def estimated_rows(self, table: Table) -> int:
        return self.frame(table.name).count()  # from the files' footers

    def position(self) -> dict | None:
        return self.at


class JdbcSource:
    """Tables of a database; needs its JDBC driver on Spark's class path."""

    def __init__(self, spark: SparkSession, source: Source, scope: Scope, url: str | None = None, mode: Mode = "safe", fetch_size: int = 1000):
        self.spark, self.scope, self.mode = spark, scope, mode
        self.options = {
            "url": url or f"jdbc:mysql://{source.addr}/?useCursorFetch=true&characterEncoding={source.charset}",
            "user": source.user,
            "password": source.password,
            "fetchsize": str(fetch_size),
            "preferTimestampNTZ": "true",
        }

    def query(self, sql: str) -> DataFrame:
        return self.spark.read.format("jdbc").options(**self.options, query=sql).load()

    def tables(self) -> list[Table]:
        """Base tables in scope that have a primary key, by database and name."""
        out = []
        for database in self.scope.databases:
            literal = "'" + database.replace("'", "''") + "'"
            names = self.query(f"SELECT TABLE_NAME AS n FROM information_schema.TABLES WHERE TABLE_SCHEMA = {literal} AND TABLE_TYPE = 'BASE TABLE'")
            for (name,) in sorted(names.collect()):
                if not self.scope.has(database, name):
                    continue
                table = self.table(database, name)
                if table.key:
                    out.append(table)
                else:
                    log.warning("%s.%s has no primary key and is skipped", database, name)
        return out

    def table(self, database: str, name: str) -> Table:
        where = " AND ".join(f"{c} = '{v.replace(chr(39), chr(39) * 2)}'" for c, v in (("TABLE_SCHEMA", database), ("TABLE_NAME", name)))
        rows = self.query(
            "SELECT COLUMN_NAME AS n, COLUMN_TYPE AS t, IS_NULLABLE AS o, COLUMN_KEY AS k, ORDINAL_POSITION AS p "
            f"FROM information_schema.COLUMNS WHERE {where}"
        )
        found = sorted(rows.collect(), key=lambda r: r.p)
        if not found:
            raise LookupError(f"no table {database}.{name}")
        key = tuple(r.n for r in found if r.k == "PRI")
        fields = [T.StructField(r.n, spark_type(r.t, self.mode), r.o == "YES" and r.n not in key, {"source_type": r.t, "pk": r.n in key}) for r in found]
        return Table(database, name, T.StructType(fields), key)

    @staticmethod
    def _name(table: Table) -> str:
        return ".".join("`" + n.replace("`", "``") + "`" for n in (table.schema, table.name))

    def ranges(self, table: Table, parts: int) -> list[Range]:
        if parts <= 1 or len(table.key) != 1 or not is_integer(table.struct[table.key[0]].metadata.get("source_type", "")):
            return [Range()]
        key = "`" + table.key[0].replace("`", "``") + "`"
        low, high = self.query(f"SELECT MIN({key}) AS a, MAX({key}) AS b FROM {self._name(table)}").first()
        return plan_ranges(low, high, table.key[0], parts)

    def read(self, table: Table, ranges: Sequence[Range]) -> DataFrame:
        rows = self.spark.read.jdbc(self.options["url"], self._name(table), predicates=[r.sql() for r in ranges], properties={k: v for k, v in self.options.items() if k != "url"})
        for f in rows.schema.fields:
            if isinstance(f.dataType, T.TimestampType):
                rows = rows.withColumn(f.name, wall_clock_column(rows[f.name]))
        return rows

    def estimated_rows(self, table: Table) -> int:
        where = " AND ".join(f"{c} = '{v.replace(chr(39), chr(39) * 2)}'" for c, v in (("TABLE_SCHEMA", table.schema), ("TABLE_NAME", table.name)))
        found = self.query(f"SELECT TABLE_ROWS AS n FROM information_schema.TABLES WHERE {where}").first()
        return max(0, int(found.n)) if found and found.n is not None else 0

    def position(self) -> dict | None:
        """The transaction set executed so far, read before the snapshot; an empty one is an error."""
        gtid = self.query("SELECT @@GLOBAL.gtid_executed AS g").first().g
        if not gtid:
            raise RuntimeError("the source reports no executed transaction set; enable GTIDs")
        return {"file": "", "pos": 0, "gtid": gtid.replace("\n", "")}


def snapshot(catalog: Catalog, source: TableSource, parts: int = 4) -> dict[tuple[str, str], Manifest]:
    """Copy every table of the source; returns the version committed for each.

    The position is taken first, so changes made meanwhile are replayed on top.  The first
    error stops what has not begun and is raised; its table keeps its former version.
    """
    position = source.position()
    if position is not None:
        position = position | {"base": dict(position)}  # changes up to here are in the copy
    tables = source.tables()

    def copy(table: Table) -> Manifest:
        catalog.create(table.schema, table.name, table.struct, table.key)
        try:
            ranges = source.ranges(table, parts)
        except Exception as e:  # a plan is an optimisation
            log.warning("%s.%s is read in one piece: %s", table.schema, table.name, e)
            ranges = [Range()]
        rows = shaped(source.read(table, ranges), [f.name for f in catalog.need(table.schema, table.name).fields])
        about = source.estimated_rows(table)
        with Watch(catalog.spark, f"{table.schema}.{table.name}", about):
            return catalog.load(table.schema, table.name, rows, position, about)

    with ThreadPoolExecutor(max_workers=max(1, min(parts, len(tables) or 1))) as pool:
        jobs = {pool.submit(copy, t): t for t in tables}
        done, waiting = wait(jobs, return_when=FIRST_EXCEPTION)
        for job in waiting:
            job.cancel()
        for job in done:
            job.result()
    return {(jobs[j].schema, jobs[j].name): j.result() for j in jobs if not j.cancelled()}
