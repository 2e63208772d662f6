"""Mirrored tables: Parquet files dealt into buckets of the key, under a versioned manifest.

A manifest names, per bucket, the files of one version of a table, its columns (with ids, so
that a column dropped and added again does not bring old values back), key, and the stream
position that this version stands for.  Data and position are committed together, by one
rename onto the next version's name, which fails if that version exists; so a change batch
is applied once, however often it is delivered.  Readers keep the version they opened.

Applying a batch rewrites only the buckets it touches; adding, dropping and renaming columns
or tables and truncating write a manifest and no data.

The folder has to be on a file system where renaming onto an existing name fails (HDFS, a
local disk).  Object stores without conditional writes do not give that, so there only one
writer may commit at a time.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.apply import OP, PUT, apply_folded, fold

ATTEMPTS = 8
WAIT_S = 0.005
#: Rows a bucket is meant to hold when a table is first written.
BUCKET_ROWS = 2_000_000
MOST_BUCKETS = 65_536
FIRST_BUCKETS = 16


class Conflict(RuntimeError):
    """Another writer committed this version first."""


def with_retry(action: Callable[[], Any], attempts: int = ATTEMPTS, wait_s: float = WAIT_S) -> Any:
    """Run again after a conflict, waiting a little longer each time."""
    for k in range(1, attempts + 1):
        try:
            return action()
        except Conflict:
            if k == attempts:
                raise
            time.sleep(wait_s * k)
    return None


@dataclass(frozen=True)
class Field:
    id: int
    name: str
    type: str
    nullable: bool = True


@dataclass(frozen=True)
class Manifest:
    schema: str
    table: str
    version: int
    fields: tuple[Field, ...]
    key: tuple[str, ...]
    buckets: int
    files: dict[int, tuple[str, ...]] = field(default_factory=dict)
    position: dict | None = None
    batch: int = -1
    next_id: int = 0
    dropped: bool = False

    def to_json(self) -> str:
        return json.dumps(self.__dict__ | {"fields": [f.__dict__ for f in self.fields], "files": {str(k): list(v) for k, v in self.files.items()}})

    @classmethod
    def from_json(cls, text: str) -> Manifest:
        raw = json.loads(text)
        return cls(**raw | {"fields": tuple(Field(**f) for f in raw["fields"]), "key": tuple(raw["key"]), "files": {int(k): tuple(v) for k, v in raw["files"].items()}})

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, T._parse_datatype_string(f.type), f.nullable) for f in self.fields])

    @property
    def stored(self) -> T.StructType:
        """The columns as files name them: by field id."""
        return T.StructType([T.StructField(f"f{f.id}", T._parse_datatype_string(f.type), True) for f in self.fields])


class Files:
    """The few file operations a catalog needs, on any file system that Spark reads."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def fs(self, name: str):
        return self.path(name).getFileSystem(self.conf)

    def names(self, folder: str) -> list[str]:
        fs, path = self.fs(folder), self.path(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def read(self, name: str) -> str:
        stream = self.fs(name).open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put_new(self, name: str, text: str) -> None:
        """Write a file that must not exist yet: under another name, then renamed."""
        fs, temporary = self.fs(name), f"{name}.{uuid.uuid4().hex}.tmp"
        stream = fs.create(self.path(temporary), True)
        stream.write(bytearray(text.encode()))
        stream.close()
        if fs.exists(self.path(name)) or not fs.rename(self.path(temporary), self.path(name)):
            fs.delete(self.path(temporary), False)
            raise Conflict(name)

    def delete(self, name: str) -> None:
        self.fs(name).delete(self.path(name), True)


class Catalog:
    """All mirrored tables under one folder.

    ``target_schema`` maps a source database to the schema its tables get; by default a
    database named like the catalog goes to ``main``.
    """

    def __init__(self, spark: SparkSession, root: str, name: str = "mirror", target_schema: Callable[[str], str] | None = None):
        self.spark, self.root, self.name, self.files = spark, root.rstrip("/"), name, Files(spark)
        self.target_schema = target_schema or (lambda db: "main" if db == name or not db else db)

    def _home(self, schema: str, table: str) -> str:
        return f"{self.root}/{self.target_schema(schema)}/{table}"

    def versions(self, schema: str, table: str) -> list[int]:
        return sorted(int(n[1:-5]) for n in self.files.names(f"{self._home(schema, table)}/manifests") if n.startswith("v") and n.endswith(".json"))

    def get(self, schema: str, table: str, version: int | None = None) -> Manifest | None:
        """A version of a table, the latest by default; None if there is none or it was dropped."""
        found = self.last(schema, table, version)
        return None if found is None or found.dropped else found

    def last(self, schema: str, table: str, version: int | None = None) -> Manifest | None:
        """Like :meth:`get`, but a dropped table's last version too, with the position at which it was dropped."""
        return self._version(self._home(schema, table), version)

    def _version(self, home: str, version: int | None = None) -> Manifest | None:
        if version is None:
            known = [n for n in self.files.names(f"{home}/manifests") if n.startswith("v") and n.endswith(".json")]
            if not known:
                return None
            name = max(known)
        else:
            name = f"v{version:012d}.json"
        return Manifest.from_json(self.files.read(f"{home}/manifests/{name}"))

    def need(self, schema: str, table: str) -> Manifest:
        found = self.get(schema, table)
        if found is None:
            raise LookupError(f"no table {schema}.{table}")
        return found

    def tables(self) -> list[tuple[str, str]]:
        found = [(s, t) for s in self.files.names(self.root) if not s.startswith("_") for t in self.files.names(f"{self.root}/{s}")]
        return [(s, t) for s, t in found if (m := self._version(f"{self.root}/{s}/{t}")) is not None and not m.dropped]

    def commit(self, manifest: Manifest, schema: str, table: str) -> Manifest:
        """Make ``manifest`` the next version; Conflict if there is one already."""
        known = self.versions(schema, table)
        manifest = replace(manifest, schema=schema, table=table, version=manifest.version + 1)
        if known and known[-1] >= manifest.version:
            raise Conflict(f"{schema}.{table} v{manifest.version}")
        self.files.put_new(f"{self._home(schema, table)}/manifests/v{manifest.version:012d}.json", manifest.to_json())
        return manifest

    # Definitions

    def create(self, schema: str, table: str, struct: T.StructType, key: Sequence[str], buckets: int = FIRST_BUCKETS) -> Manifest:
        """Create a table unless it exists; an existing one keeps its definition.  :meth:`load` sets the buckets by the rows."""
        known = self.versions(schema, table)
        found = self.get(schema, table)
        if found is not None:
            return found
        fields = tuple(Field(i, f.name, f.dataType.simpleString(), f.nullable and f.name not in key) for i, f in enumerate(struct.fields))
        return self.commit(Manifest(schema, table, known[-1] if known else -1, fields, tuple(key), buckets, next_id=len(fields)), schema, table)

    def drop(self, schema: str, table: str, position: dict | None = None) -> None:
        """The last version says that there is no table, and since which position."""
        found = self.get(schema, table)
        if found is not None:
            self.commit(replace(found, dropped=True, files={}, position=merged(found.position, position)), schema, table)

    def rename(self, schema: str, table: str, new_table: str, position: dict | None = None) -> Manifest:
        """Within one schema; files stay where they are, as manifests name them by path.

        With a position, a rename that was cut off after its first half is finished.
        """
        found, there = self.need(schema, table), self.get(schema, new_table)
        if there is not None and (position is None or (there.position or {}).get("ddl") != position.get("ddl")):
            raise ValueError(f"{schema}.{new_table} exists")
        known = self.versions(schema, new_table)
        moved = replace(found, version=known[-1] if known else -1, position=merged(found.position, position))
        made = there or self.commit(moved, schema, new_table)
        self.drop(schema, table, position)
        return made

    def add_column(self, schema: str, table: str, name: str, kind: T.DataType) -> Manifest:
        """Existing rows get null, so the column takes nulls whatever the source says."""
        found = self.need(schema, table)
        if name in found.columns:
            raise ValueError(f"column {name} exists")
        added = Field(found.next_id, name, kind.simpleString(), True)
        return self.commit(replace(found, fields=(*found.fields, added), next_id=found.next_id + 1), schema, table)

    def drop_column(self, schema: str, table: str, name: str) -> Manifest:
        found = self.need(schema, table)
        if name in found.key:
            raise ValueError(f"column {name} is part of the primary key")
        return self.commit(replace(found, fields=tuple(f for f in found.fields if f.name != name)), schema, table)

    def truncate(self, schema: str, table: str) -> Manifest:
        return self.commit(replace(self.need(schema, table), files={}), schema, table)

    # Rows

    def read(self, schema: str, table: str, version: int | None = None) -> DataFrame:
        found = self.get(schema, table, version)
        if found is None:
            raise LookupError(f"no table {schema}.{table}")
        return self._rows(found, None)

    def _rows(self, m: Manifest, buckets: set[int] | None) -> DataFrame:
        paths = [p for b, files in sorted(m.files.items()) if buckets is None or b in buckets for p in files]
        if not paths:
            return self.spark.createDataFrame([], T.StructType([T.StructField(f.name, f.dataType, True) for f in m.struct.fields]))
        stored = self.spark.read.schema(m.stored).parquet(*paths)
        return stored.select(*[F.col(f"f{f.id}").alias(f.name) for f in m.fields])

    def _bucket(self, m: Manifest):
        return F.pmod(F.xxhash64(*[F.col("`" + k.replace("`", "``") + "`") for k in m.key]), F.lit(m.buckets)).cast("int")

    def _write(self, m: Manifest, rows: DataFrame) -> dict[int, tuple[str, ...]]:
        """Write rows by bucket; one shuffle on the bucket, so that each bucket is one file or few."""
        folder = f"{self.root}/_data/{uuid.uuid4().hex}"
        named = rows.select(*[F.col("`" + f.name.replace("`", "``") + "`").cast(f.type).alias(f"f{f.id}") for f in m.fields], self._bucket(m).alias("bucket"))
        named.repartition("bucket").write.partitionBy("bucket").parquet(folder)
        out = {}
        for part in self.files.names(folder):
            if part.startswith("bucket="):
                out[int(part[7:])] = tuple(f"{folder}/{part}/{n}" for n in self.files.names(f"{folder}/{part}") if n.endswith(".parquet"))
        return out

    def load(self, schema: str, table: str, rows: DataFrame, position: dict | None = None, about: int | None = None) -> Manifest:
        """Replace all rows: truncate and reload in one version.  Keys have to be unique and not null.

        The rows are read once and written; their keys are checked where they were written.
        ``about`` is how many rows are expected, which sets the number of buckets.
        """
        m = self.need(schema, table)
        if about is not None:
            m = replace(m, buckets=max(FIRST_BUCKETS, min(MOST_BUCKETS, -(-about // BUCKET_ROWS))))
        made = replace(m, files=self._write(m, rows), position=position or m.position)
        try:
            self._check_key(m, self._rows(made, None))
        except ValueError:
            self._forget(made)
            raise
        return self.commit(made, schema, table)

    def _forget(self, m: Manifest) -> None:
        """Delete the files of a version that is not committed."""
        for folder in {p.rsplit("/bucket=", 1)[0] for files in m.files.values() for p in files}:
            self.files.delete(folder)

    def rebucket(self, schema: str, table: str) -> Manifest:
        """Deal a table that has grown into as many buckets as its rows ask for; one reading and writing, no other change."""
        m = self.need(schema, table)
        rows = self._rows(m, None)
        wanted = max(FIRST_BUCKETS, min(MOST_BUCKETS, -(-rows.count() // BUCKET_ROWS)))  # counted from the files' footers
        if wanted <= m.buckets:
            return m
        m = replace(m, buckets=wanted)
        return self.commit(replace(m, files=self._write(m, rows)), schema, table)

    def insert(self, schema: str, table: str, rows: DataFrame) -> Manifest:
        """Append; a key that exists is an error."""
        m = self.need(schema, table)
        if m.key:
            self._check_key(m, rows)
            if not rows.join(self._rows(m, None).select(*m.key), list(m.key), "left_semi").isEmpty():
                raise ValueError(f"duplicate key in {schema}.{table}")
        added = self._write(m, rows)
        return self.commit(replace(m, files={b: (*m.files.get(b, ()), *added.get(b, ())) for b in {*m.files, *added}}), schema, table)

    def _check_key(self, m: Manifest, rows: DataFrame) -> None:
        if not m.key:
            return
        keys = [F.col("`" + k.replace("`", "``") + "`") for k in m.key]
        bad = rows.groupBy(*keys).count().where(" or ".join([f"`{k}` is null" for k in m.key] + ["`count` > 1"]))
        if not bad.isEmpty():
            raise ValueError(f"null or duplicate key in {m.schema}.{m.table}")

    def apply(self, schema: str, table: str, log: DataFrame, position: dict | None = None, batch: int | None = None) -> Manifest:
        """Apply changes (see operators.apply) and the position they lead to, in one version.

        A batch number not above the table's is a batch applied before: nothing happens.
        """

        def once() -> Manifest:
            m = self.need(schema, table)
            if batch is not None and batch <= m.batch:
                return m
            if not m.key:
                raise ValueError(f"{schema}.{table} has no primary key")
            last = fold(log, m.key).withColumn("__bucket", self._bucket(m)).persist()
            try:
                touched = {r[0] for r in last.select("__bucket").distinct().collect()}  # at most the number of buckets
                new = apply_folded(self._rows(m, touched), last.drop("__bucket"), m.key)
                written = self._write(m, new) if touched else {}
            finally:
                last.unpersist()
            kept = {b: f for b, f in m.files.items() if b not in touched}
            return self.commit(replace(m, files=kept | written, position=merged(m.position, position), batch=m.batch if batch is None else batch), schema, table)

        return with_retry(once)

    def upsert(self, schema: str, table: str, rows: DataFrame, seq: str) -> Manifest:
        from tidemark.operators.apply import changes

        return self.apply(schema, table, changes(rows, PUT, seq).drop(seq) if seq not in self.need(schema, table).columns else changes(rows, PUT, seq))

    def delete(self, schema: str, table: str, keys: DataFrame) -> Manifest:
        """Delete by primary key; other columns of ``keys`` do not matter."""
        m = self.need(schema, table)
        rows = keys.select(*m.key, *[F.lit(None).cast(f.type).alias(f.name) for f in m.fields if f.name not in m.key]).select(*m.columns)
        log = rows.withColumns({"__seq": F.struct(F.lit(0).cast("long").alias("at"), F.lit(0).alias("sub")), OP: F.lit("delete")})
        return self.apply(schema, table, log)

    def expire(self, schema: str, table: str, keep: int = 2) -> None:
        """Delete files that only versions before the last ``keep`` name."""
        known = self.versions(schema, table)
        home, old, new = self._home(schema, table), known[:-keep], known[-keep:]
        load = lambda v: Manifest.from_json(self.files.read(f"{home}/manifests/v{v:012d}.json"))
        needed = {p for v in new for files in load(v).files.values() for p in files}
        for v in old:
            for files in load(v).files.values():
                for p in files:
                    if p not in needed:
                        self.files.delete(p)
            self.files.delete(f"{home}/manifests/v{v:012d}.json")

    def register(self) -> list[str]:
        """A temporary view per table, bound to its latest version: schema_table, and the bare name in ``main``."""
        made = []
        for schema, table in self.tables():
            self._rows(self._version(f"{self.root}/{schema}/{table}"), None).createOrReplaceTempView(view_name(schema, table))
            made.append(view_name(schema, table))
        return made


def view_name(schema: str, table: str) -> str:
    return table if schema == "main" else f"{schema}_{table}"


def merged(old: dict | None, new: dict | None) -> dict | None:
    """A position never loses a known transaction set, nor what its snapshot and last schema change were."""
    if new is None:
        return old
    kept = {k: old[k] for k in ("gtid", "base", "ddl") if old and old.get(k) and not new.get(k)}
    return new | kept


def add_gtid(known: str, more: str) -> str:
    """Union of transaction sets, each ``uuid:1-5:7,uuid:...``."""
    spans: dict[str, list[tuple[int, int]]] = {}
    for part in ",".join(p for p in (known, more) if p).replace("\n", "").split(","):
        if part.strip():
            server, *ranges = part.strip().split(":")
            for r in ranges:
                a, _, b = r.partition("-")
                spans.setdefault(server.lower(), []).append((int(a), int(b or a)))
    out = []
    for server in sorted(spans):
        joined: list[list[int]] = []
        for a, b in sorted(spans[server]):
            if joined and a <= joined[-1][1] + 1:
                joined[-1][1] = max(joined[-1][1], b)
            else:
                joined.append([a, b])
        out.append(":".join([server, *(f"{a}-{b}" if a < b else str(a) for a, b in joined)]))
    return ",".join(out)
