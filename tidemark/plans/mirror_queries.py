"""Queries of the mirror itself: snapshots, change application, schema changes, parsing, scope."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import ddl
from tidemark.functions.source_types import target_name_column
from tidemark.functions.values import rfc3339_column, shortened
from tidemark.operators import apply as ops
from tidemark.operators.ranges import Range, ranges_of, split
from tidemark.plans import readonly
from tidemark.sources.config import Scope


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_ranges(table: DataFrame, ranges: list[Range]) -> DataFrame:
    parts = [table.where(r.holds()) for r in ranges]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# Snapshots


def snapshot_full_orders(spark, sf_dir):
    return read(spark, sf_dir, "orders")


def snapshot_ranges_union(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    return in_ranges(orders, ranges_of(orders, ["o_orderkey"], 4))


_PLANNED = {"orders": "o_orderkey", "part": "p_partkey", "customer": "c_custkey"}


def pk_split_plan(spark, sf_dir):
    """The bounds of four ranges of three tables, from one aggregate each."""
    rows = []
    for table, key in _PLANNED.items():
        low, high = read(spark, sf_dir, table).agg(F.min(key), F.max(key)).first()
        rows += [(table, i, a, b) for i, (a, b) in enumerate(split(low, high, 4))]
    return spark.createDataFrame(rows, "tbl string, part int, low long, high long")


def _pk_split_oracle() -> str:
    one = """SELECT '{t}' AS tbl, CAST(i AS INTEGER) AS part, CAST(a + (b - a + 1) * i // n AS BIGINT) AS low,
        CAST(CASE WHEN i = n - 1 THEN b ELSE a + (b - a + 1) * (i + 1) // n END AS BIGINT) AS high
        FROM (SELECT min({k}) AS a, max({k}) AS b, least(4, max({k}) - min({k}) + 1) AS n FROM {t}), range(4) r(i) WHERE i < n"""
    return " UNION ALL ".join(one.format(t=t, k=k) for t, k in _PLANNED.items())


def pk_range_counts(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    ranges = ranges_of(orders, ["o_orderkey"], 4)
    which = F.coalesce(*[F.when(r.holds(), F.lit(i)) for i, r in enumerate(ranges)])
    return orders.groupBy(which.alias("part")).agg(F.count(F.lit(1)).alias("n"))


def composite_pk_single_stream(spark, sf_dir):
    """A composite key is not cut: one range, all rows."""
    lines = read(spark, sf_dir, "lineitem")
    return in_ranges(lines, ranges_of(lines, ["l_orderkey", "l_linenumber"], 4)).agg(F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("keys"))


def row_estimate(spark, sf_dir):
    names = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
    return spark.createDataFrame([(n, read(spark, sf_dir, n).count()) for n in names], "tbl string, n long")


def truncate_reload(spark, sf_dir):
    """A table filled twice: the second load replaces the first."""
    from tidemark.operators.store import Catalog

    catalog = Catalog(spark, scratch(spark), "mirror")
    nation = read(spark, sf_dir, "nation")
    catalog.create("demo", "nation", nation.schema, ["n_nationkey"], 2)
    catalog.load("demo", "nation", nation.where("n_regionkey = 1"))
    catalog.truncate("demo", "nation")
    catalog.load("demo", "nation", nation)
    return catalog.read("demo", "nation")


def scratch(spark: SparkSession) -> str:
    """A folder that driver and executors share.  Where none is configured: an error on a cluster, a temporary one on one machine (tests)."""
    import tempfile
    import uuid

    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{shared.rstrip('/')}/tidemark-{uuid.uuid4().hex}" if shared else tempfile.mkdtemp(prefix="tidemark-")


# Changes


def event_log(spark, sf_dir) -> DataFrame:
    """Events as changes of their user: an error deletes, anything else puts."""
    events = read(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    return ops.changes(events, F.when(F.col("event_type") == "error", ops.DELETE).otherwise(ops.PUT), "event_id")


def _no_rows(spark, log: DataFrame) -> DataFrame:
    return spark.createDataFrame([], T.StructType([f for f in log.schema.fields if not f.name.startswith("__")]))


def cdc_apply_events(spark, sf_dir):
    log = event_log(spark, sf_dir)
    return ops.apply(_no_rows(spark, log), log, ["user_id"])


_LAST = "SELECT user_id, event_id, event_type, value FROM events {where} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1"
_LIVE = f"SELECT * FROM ({_LAST.format(where='')}) WHERE event_type <> 'error'"


def cdc_replay_idempotent(spark, sf_dir):
    """A prefix delivered again, from any position, changes nothing."""
    log = event_log(spark, sf_dir)
    once = ops.apply(_no_rows(spark, log), log, ["user_id"])
    return ops.apply(once, log.where("event_id % 3 = 0 or event_id > 50"), ["user_id"]).unionByName(once.limit(0))


def _cdc_replay_oracle() -> str:
    # Replaying a subset that is not a suffix may only matter for keys whose last change is not in it.
    return f"""WITH state AS ({_LIVE}), again AS ({_LAST.format(where='WHERE event_id % 3 = 0 OR event_id > 50')})
        SELECT * FROM state WHERE user_id NOT IN (SELECT user_id FROM again) UNION ALL SELECT * FROM again WHERE event_type <> 'error'"""


def cdc_microbatches(spark, sf_dir):
    """Four batches, one after another, give what one batch gives."""
    log = event_log(spark, sf_dir)
    state, high = _no_rows(spark, log), log.agg(F.max("event_id")).first()[0] + 1
    for i in range(4):
        state = ops.apply(state, log.where((F.col("event_id") >= high * i // 4) & (F.col("event_id") < high * (i + 1) // 4)), ["user_id"])
    return state


def cdc_apply_onto_base(spark, sf_dir):
    """Customers, with each one's latest order as an upsert of the balance."""
    base = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    rows = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("c_name"), F.col("o_totalprice").alias("c_acctbal"), "o_orderkey")
    return ops.apply(base, ops.changes(rows, ops.PUT, "o_orderkey").drop("o_orderkey"), ["c_custkey"])


def cdc_insert_over_existing(spark, sf_dir):
    """Inserts of keys that exist replace them."""
    events = read(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    half = events.where("event_id % 2 = 0")
    base = ops.apply(events.limit(0), ops.changes(half, ops.PUT, "event_id"), ["user_id"])
    return ops.apply(base, ops.changes(events.where("event_id % 2 = 1"), ops.PUT, "event_id"), ["user_id"])


def _update_pairs(spark, sf_dir) -> DataFrame:
    """Each event turns its user's row into its own; every tenth event also moves the user to a new key."""
    from pyspark.sql import Window

    key = F.when(F.col("event_id") % 10 == 0, F.col("user_id") + 1_000_000).otherwise(F.col("user_id"))
    events = read(spark, sf_dir, "events").select("user_id", key.alias("k"), "event_id", "event_type")
    before = F.lag(F.struct("k", "event_id", "event_type")).over(Window.partitionBy("user_id").orderBy("event_id"))
    return events.select(before.alias("before"), F.struct("k", "event_id", "event_type").alias("after"), F.col("event_id").alias("seq"))


def _pk_change(spark, sf_dir, safe: bool) -> DataFrame:
    pairs = _update_pairs(spark, sf_dir)
    columns = ["k", "event_id", "event_type"]
    log = ops.updates(pairs.where("before is not null"), columns, ["k"], "before", "after", "seq", safe)
    first = ops.changes(pairs.where("before is null").select("after.*", F.col("seq").alias("s")), ops.PUT, "s", 1).drop("s")
    log = log.unionByName(first)
    return ops.apply(_no_rows(spark, log), log, ["k"])


def cdc_pk_change_reference(spark, sf_dir):
    return _pk_change(spark, sf_dir, False)


def cdc_pk_change_safe(spark, sf_dir):
    return _pk_change(spark, sf_dir, True)


_KEYED = "SELECT CASE WHEN event_id % 10 = 0 THEN user_id + 1000000 ELSE user_id END AS k, user_id, event_id, event_type FROM events"


def cdc_update_after_image(spark, sf_dir):
    """Updates keep the after image; the before image is not looked at while keys stay."""
    pairs = _update_pairs(spark, sf_dir).where("before is not null")
    columns = ["user_id", "event_id"]
    flat = pairs.select(*[F.struct((F.col(f"{s}.k") % 1_000_000).alias("user_id"), F.col(f"{s}.event_id").alias("event_id")).alias(s) for s in ("before", "after")], "seq")
    log = ops.updates(flat, columns, ["user_id"], "before", "after", "seq", False)
    return ops.apply(_no_rows(spark, log), log, ["user_id"])


def cdc_upsert_lww_composite(spark, sf_dir):
    """A composite key with several versions: the largest of the other columns is the last."""
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    log = lines.withColumns({ops.SEQ: F.struct("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"), ops.OP: F.lit(ops.PUT)})
    return ops.apply(lines.limit(0), log, ["l_orderkey", "l_linenumber"])


def cdc_delete_by_pk(spark, sf_dir):
    """Deletes by key, some of keys that do not exist."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    gone = orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_orderstatus").unionByName(orders.select((-F.col("o_orderkey") - 1).alias("o_orderkey"), "o_custkey", "o_orderstatus"))
    return ops.apply(orders, ops.changes(gone, ops.DELETE, "o_orderkey"), ["o_orderkey"])


def change_log(spark, sf_dir) -> DataFrame:
    """Events in the form of the change stream."""
    image = F.to_json(F.struct("user_id", "event_id", "event_type", "value"))
    return read(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"), F.lit("log.1").alias("file"), F.col("event_id").alias("pos"),
        F.concat(F.lit("3e11fa47-71ca-11e1-9e33-c80aa9429562:"), F.col("event_id") + 1).alias("gtid"),
        F.lit("demo").alias("db"), F.lit("users").alias("tbl"),
        F.when(F.col("event_type") == "error", "delete").otherwise("insert").alias("kind"),
        image.alias("before"), image.alias("after"), F.lit(None).cast("string").alias("ddl_sql"),
    )


_USERS = T.StructType().add("user_id", T.LongType()).add("event_id", T.LongType()).add("event_type", T.StringType()).add("value", T.DoubleType())


def cdc_stream_equals_batch(spark, sf_dir):
    """The events as files of a change log, followed by a streaming query into a versioned table."""
    from tidemark.operators.store import Catalog
    from tidemark.streaming.changes import Applier, stream

    home = scratch(spark)
    change_log(spark, sf_dir).write.parquet(f"{home}/log")
    catalog = Catalog(spark, f"{home}/tables", "mirror")
    catalog.create("demo", "users", _USERS, ["user_id"], 4)
    stream(spark, f"{home}/log", Applier(catalog, Scope(("demo",))), f"{home}/checkpoint", "parquet").awaitTermination()
    return catalog.read("demo", "users")


# Schema changes


def _suppliers(spark, sf_dir):
    from tidemark.operators.store import Catalog

    catalog = Catalog(spark, scratch(spark), "mirror")
    rows = read(spark, sf_dir, "supplier")
    catalog.create("demo", "supplier", rows.schema, ["s_suppkey"], 4)
    catalog.load("demo", "supplier", rows)
    return catalog


def ddl_add_column_nulls(spark, sf_dir):
    catalog = _suppliers(spark, sf_dir)
    catalog.add_column("demo", "supplier", "s_note", T.StringType())
    return catalog.read("demo", "supplier")


def ddl_drop_column(spark, sf_dir):
    """A column dropped and added again comes back empty."""
    catalog = _suppliers(spark, sf_dir)
    catalog.drop_column("demo", "supplier", "s_acctbal")
    catalog.add_column("demo", "supplier", "s_acctbal", T.DoubleType())
    return catalog.read("demo", "supplier")


def ddl_rename_table(spark, sf_dir):
    catalog = _suppliers(spark, sf_dir)
    catalog.rename("demo", "supplier", "vendor")
    assert catalog.get("demo", "supplier") is None
    return catalog.read("demo", "vendor")


# Parsing, scope, values

#: Source types and what they become.
TYPES = (
    ("int(11)", "INTEGER"), ("bigint unsigned", "BIGINT"), ("tinyint(1)", "BOOLEAN"), ("decimal(12,2)", "DECIMAL(12,2)"), ("varchar(64)", "VARCHAR"),
    ("datetime", "TIMESTAMP"), ("json", "JSON"), ("blob", "BLOB"), ("enum('a','b')", "VARCHAR"), ("bit(8)", "BIGINT"), ("decimal", "DECIMAL(38,10)"),
    ("decimal(10)", "DECIMAL(38,10)"), ("decimal(12, 2)", "DECIMAL(38,10)"), ("tinyint(1) unsigned", "BOOLEAN"), ("tinyint unsigned", "TINYINT"),
    ("geometry", "VARCHAR"), ("smallint(6)", "SMALLINT"), ("mediumint", "INTEGER"), ("float", "FLOAT"), ("double precision", "DOUBLE"), ("real", "DOUBLE"),
    ("bool", "BOOLEAN"), ("timestamp(6)", "TIMESTAMP"), ("date", "DATE"), ("time", "TIME"), ("year(4)", "INTEGER"), ("char(2)", "VARCHAR"), ("longtext", "VARCHAR"),
    ("varbinary(16)", "BLOB"), ("set('x')", "VARCHAR"), (" INT ", "INTEGER"),
)


def _values(rows, columns: str) -> str:
    quote = lambda v: "NULL" if v is None else str(v).upper() if isinstance(v, bool) else str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(quote, r)) + ')' for r in rows)}) AS t({columns})"


def type_map_reference(spark, sf_dir):
    rows = spark.createDataFrame([(s,) for s, _ in TYPES], "source string")
    return rows.select("source", target_name_column(F.col("source")).alias("target"))


#: Statements, and the first change that the reference mode and the safe mode see (kind, table, column).
STATEMENTS = (
    ("CREATE TABLE `demo`.`t1` (id INT PRIMARY KEY)", ("create", "t1", ""), ("create", "t1", "")),
    ("ALTER TABLE users ADD COLUMN age INT", ("add_column", "users", "age"), ("add_column", "users", "age")),
    ("DROP TABLE IF EXISTS demo.users", ("drop", "users", ""), ("drop", "users", "")),
    ("RENAME TABLE demo.a TO demo.b", ("rename", "a", ""), ("rename", "a", "")),
    ("ALTER TABLE t DROP c", ("drop_column", "t", "c"), ("drop_column", "t", "c")),
    ("ALTER TABLE t RENAME TO x", ("rename", "t", ""), ("rename", "t", "")),
    ("ALTER TABLE t RENAME x", ("unsupported", "", ""), ("rename", "t", "")),
    ("ALTER TABLE t MODIFY c BIGINT", ("unsupported", "", ""), ("unsupported", "t", "")),
    ("CREATE INDEX i ON t (a)", ("unsupported", "", ""), ("unsupported", "", "")),
    ("TRUNCATE TABLE t", None, ("truncate", "t", "")),
    ("/* c */ DROP TABLE t", None, ("drop", "t", "")),
    ("ALTER TABLE t ADD INDEX idx (a)", ("add_column", "t", "INDEX"), ("unsupported", "t", "")),
    ("ALTER TABLE t DROP INDEX idx", ("drop_column", "t", "INDEX"), ("unsupported", "t", "")),
    ("ALTER TABLE t ADD COLUMN (a INT, b INT)", ("add_column", "t", "COLUMN"), ("add_column", "t", "a")),
    ("ALTER TABLE t ADD COLUMN IF NOT EXISTS a INT", ("add_column", "t", "IF"), ("add_column", "t", "a")),
    ("DROP TABLE `my-tbl`", ("drop", "my", ""), ("drop", "my-tbl", "")),
    ("ALTER TABLE t ADD COLUMN a INT, ADD COLUMN b INT", ("add_column", "t", "a"), ("add_column", "t", "a")),
    ("ALTER TABLE t ADD COLUMN a DECIMAL(12, 2)", ("add_column", "t", "a"), ("add_column", "t", "a")),
    ("DROP TABLE a, b", ("drop", "a", ""), ("drop", "a", "")),
    ("DROP TEMPORARY TABLE t", ("unsupported", "", ""), None),
    ("CREATE TEMPORARY TABLE t (id INT)", ("unsupported", "", ""), None),
    ("CREATE TABLE t LIKE u", ("create", "t", ""), ("create", "t", "")),
    ("ALTER TABLE t ADD COLUMN a INT FIRST", ("add_column", "t", "a"), ("add_column", "t", "a")),
    ("SELECT 1", None, None),
)


def ddl_parse_matrix(spark, sf_dir):
    rows = []
    for sql, _, _ in STATEMENTS:
        for mode in ("reference", "safe"):
            first = (ddl.parse(sql, "demo", mode) or [None])[0]
            rows.append((sql, mode, *((first.kind, first.table, first.column) if first else (None, None, None))))
    return spark.createDataFrame(rows, "statement string, mode string, kind string, tbl string, col string")


def _ddl_oracle() -> str:
    return _values([(s, m, *(x or (None, None, None))) for s, a, b in STATEMENTS for m, x in (("reference", a), ("safe", b))], "statement, mode, kind, tbl, col")


_NAMES = [(d, t) for d in ("demo", "app", "other") for t in ("users", "user_profile", "user_sessions", "orders", "audit_2024", "tmp_cache", "big_logs")]


def scope_filter(spark, sf_dir):
    scope = Scope(("demo", "app"), ("demo.user*", "orders", "app.*"), ("*.user_sessions", "audit_*", "app.tmp_?[a-m]*", "["))
    rows = spark.createDataFrame(_NAMES, "db string, tbl string")
    return rows.where(scope.column(F.col("db"), F.col("tbl")))


def _scope_oracle() -> str:
    names = _values(_NAMES, "db, tbl")
    return f"""SELECT db, tbl FROM ({names}) WHERE db IN ('demo', 'app') AND ((db = 'demo' AND tbl LIKE 'user%') OR tbl = 'orders' OR db = 'app')
        AND tbl <> 'user_sessions' AND NOT tbl LIKE 'audit_%' AND NOT (db = 'app' AND regexp_full_match(tbl, 'tmp_.[a-m].*'))"""


#: Statements, whether the text rules take them, and whether the plan rules do.
READONLY = (
    ("SELECT 1", True, True), ('select count(*) from main."order"', True, False), ("WITH x AS (SELECT 1 AS n) SELECT * FROM x", True, True), ("EXPLAIN SELECT 1", True, True),
    ("DELETE FROM t", False, False), ("SELECT 1; SELECT 2", False, False), ("INSERT INTO t VALUES (1)", False, False), ("DROP TABLE t", False, False),
    ("SELECT ';'", False, True), ("SELECT ' drop '", False, True), ("WITH x AS (SELECT 1)\nINSERT\nINTO t SELECT * FROM x", True, False), ("EXPLAIN DROP\nTABLE t", True, False),
    ("SELECT reflect('java.lang.System', 'exit', 0)", True, False), ("SELECT * FROM csv.`/etc/passwd`", True, False), ("SHOW TABLES", True, True),
    ("-- note\nSELECT 1", True, True), ("", False, False), ("DESCRIBE t", True, True), ("SELECT 1;", True, True), ("CACHE TABLE t", False, False), ("SET a = 1", False, False),
)


def _plan_allows(spark, sql: str) -> bool:
    try:
        readonly.check(spark, sql)
    except readonly.Refused:
        return False
    return True


def readonly_matrix(spark, sf_dir):
    rows = [(s, readonly.text_allows(s), _plan_allows(spark, s)) for s, _, _ in READONLY]
    return spark.createDataFrame(rows, "statement string, by_text boolean, by_plan boolean")


def wallclock_timestamp(spark, sf_dir):
    """Digits of the clock, whatever the session's zone."""
    return read(spark, sf_dir, "events").select("event_id", F.date_format(F.col("ts").cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss").alias("clock"))


def value_normalise(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    return orders.select("o_orderkey", rfc3339_column(F.col("o_orderdate")).alias("at"), F.col("o_totalprice").cast("decimal(18,2)").cast("double").alias("price"))


def log_lines(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", shortened(F.col("text"), 80).alias("line"))


def row_cap(spark, sf_dir):
    """The gateway's cap, on a total order."""
    from tidemark.plans.gateway import Gateway

    read(spark, sf_dir, "orders").createOrReplaceTempView("orders")
    return Gateway(spark).frame("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey", 5000)


def _mirrored(spark, sf_dir, keys: dict):
    """A catalog filled by the snapshot copy."""
    from tidemark.operators.store import Catalog
    from tidemark.sources.snapshot import ParquetSource, snapshot

    catalog = Catalog(spark, scratch(spark), "mirror")
    snapshot(catalog, ParquetSource(spark, sf_dir, "demo", keys), 4)
    return catalog


def snapshot_copy(spark, sf_dir):
    """Orders, copied by ranges of their key into the versioned store."""
    return _mirrored(spark, sf_dir, {"orders": ["o_orderkey"]}).read("demo", "orders")


def bulk_insert(spark, sf_dir):
    """Suppliers in two inserts; a third that repeats a key is refused and leaves the table as it is."""
    from tidemark.operators.store import Catalog

    catalog, rows = Catalog(spark, scratch(spark), "mirror"), read(spark, sf_dir, "supplier")
    catalog.create("demo", "supplier", rows.schema, ["s_suppkey"], 4)
    for odd in (0, 1):
        catalog.insert("demo", "supplier", rows.where(F.col("s_suppkey") % 2 == odd))
    try:
        catalog.insert("demo", "supplier", rows.where("s_nationkey = 1 or s_suppkey > 0"))
    except ValueError:
        return catalog.read("demo", "supplier")
    raise AssertionError("a repeated key was inserted")


def gateway_query(spark, sf_dir):
    """A statement over mirrored tables, by their qualified names, through the gateway to JSON rows."""
    from tidemark.plans.gateway import Gateway

    catalog = _mirrored(spark, sf_dir, {"nation": ["n_nationkey"], "region": ["r_regionkey"]})
    text = 'SELECT r_name, count(*) AS nations FROM demo.nation JOIN demo.region ON nation.n_regionkey = region."r_regionkey" GROUP BY r_name ORDER BY r_name'
    found = Gateway(spark, catalog).query(text)
    return spark.createDataFrame([(r["r_name"], r["nations"]) for r in found.rows], "r_name string, nations long")


def store_replay(spark, sf_dir):
    """The events as a change log with a rename in it, delivered twice and once more from the start to the versioned store."""
    from tidemark.operators.store import Catalog
    from tidemark.streaming.changes import Applier

    log = change_log(spark, sf_dir)
    middle = log.agg(F.max("seq")).first()[0] // 2
    rename = spark.createDataFrame([(middle * 2 + 1, "log.1", middle, "", "demo", "", "ddl", None, None, "RENAME TABLE users TO people")], log.schema)
    doubled = log.withColumns({"seq": F.col("seq") * 2, "tbl": F.when(F.col("seq") > middle, "people").otherwise("users")}).unionByName(rename)
    catalog = Catalog(spark, scratch(spark), "mirror")
    catalog.create("demo", "users", _USERS, ["user_id"], 4)
    applier = Applier(catalog, Scope(("demo",)))
    for part in (doubled.where(F.col("seq") <= middle), doubled.where(F.col("seq") <= middle), doubled, doubled):
        applier.run(part)
    return catalog.read("demo", "people")


def catalog_listing(spark, sf_dir):
    """Tables in scope with their columns in order and their keys."""
    from tidemark.sources.snapshot import ParquetSource

    source = ParquetSource(spark, sf_dir, "demo", {"nation": ["n_nationkey"], "region": ["r_regionkey"]})
    rows = [(t.name, i, f.name, f.name in t.key) for t in source.tables() for i, f in enumerate(t.struct.fields)]
    return spark.createDataFrame(rows, "tbl string, place int, col string, in_key boolean")


def flagship(spark, sf_dir):
    """Fold the event log to live rows, then aggregate them through the gateway."""
    from tidemark.plans.gateway import Gateway

    cdc_apply_events(spark, sf_dir).createOrReplaceTempView("user_state")
    return Gateway(spark).frame("SELECT event_type, count(*) AS users, max(event_id) AS last_event FROM user_state GROUP BY event_type")


QUERIES = {
    f.__name__: f
    for f in (
        snapshot_full_orders, snapshot_ranges_union, pk_split_plan, pk_range_counts, composite_pk_single_stream, row_estimate, truncate_reload, cdc_apply_events,
        cdc_replay_idempotent, cdc_microbatches, cdc_apply_onto_base, cdc_insert_over_existing, cdc_pk_change_reference, cdc_pk_change_safe, cdc_update_after_image,
        cdc_upsert_lww_composite, cdc_delete_by_pk, cdc_stream_equals_batch, ddl_add_column_nulls, ddl_drop_column, ddl_rename_table, type_map_reference,
        ddl_parse_matrix, scope_filter, readonly_matrix, wallclock_timestamp, value_normalise, log_lines, row_cap, catalog_listing, flagship,
        snapshot_copy, bulk_insert, gateway_query, store_replay,
    )
}

ORACLE = {
    "snapshot_full_orders": "SELECT * FROM orders",
    "snapshot_ranges_union": "SELECT * FROM orders",
    "pk_split_plan": _pk_split_oracle(),
    "pk_range_counts": """SELECT CAST(p AS INTEGER) AS part, count(*) AS n FROM (SELECT (SELECT max(i) FROM range(4) r(i) WHERE o_orderkey >= a + (b - a + 1) * i // 4) AS p
        FROM orders, (SELECT min(o_orderkey) AS a, max(o_orderkey) AS b FROM orders)) GROUP BY p""",
    "composite_pk_single_stream": "SELECT count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS keys FROM lineitem",
    "row_estimate": " UNION ALL ".join(f"SELECT '{t}' AS tbl, count(*) AS n FROM {t}" for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")),
    "truncate_reload": "SELECT * FROM nation",
    "cdc_apply_events": _LIVE,
    "cdc_replay_idempotent": _cdc_replay_oracle(),
    "cdc_microbatches": _LIVE,
    "cdc_stream_equals_batch": _LIVE,
    "cdc_apply_onto_base": """SELECT c_custkey, coalesce(p, c_name) AS c_name, coalesce(t, c_acctbal) AS c_acctbal FROM (SELECT c_custkey, c_name, c_acctbal FROM customer) FULL JOIN
        (SELECT o_custkey AS c_custkey, o_orderpriority AS p, o_totalprice AS t FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1) USING (c_custkey)""",
    "cdc_insert_over_existing": """SELECT user_id, event_id, event_type, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id % 2 DESC, event_id DESC) = 1""",
    "cdc_pk_change_reference": f"SELECT k, event_id, event_type FROM ({_KEYED}) QUALIFY row_number() OVER (PARTITION BY k ORDER BY event_id DESC) = 1",
    "cdc_pk_change_safe": f"SELECT k, event_id, event_type FROM ({_KEYED}) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1",
    "cdc_update_after_image": """SELECT user_id, event_id FROM (SELECT user_id, event_id, lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM events)
        WHERE before IS NOT NULL QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""",
    "cdc_upsert_lww_composite": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) = 1""",
    "cdc_delete_by_pk": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'",
    "ddl_add_column_nulls": "SELECT *, CAST(NULL AS VARCHAR) AS s_note FROM supplier",
    "ddl_drop_column": "SELECT s_suppkey, s_name, s_nationkey, CAST(NULL AS DOUBLE) AS s_acctbal FROM supplier",
    "ddl_rename_table": "SELECT * FROM supplier",
    "type_map_reference": _values(TYPES, "source, target"),
    "ddl_parse_matrix": _ddl_oracle(),
    "scope_filter": _scope_oracle(),
    "readonly_matrix": _values(READONLY, "statement, by_text, by_plan"),
    "wallclock_timestamp": "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS clock FROM events",
    "value_normalise": """SELECT o_orderkey, regexp_replace(strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f'), '\\.?0{0,6}$', '') || 'Z' AS at, o_totalprice AS price FROM orders""",
    "log_lines": "SELECT doc_id, left(replace(text, chr(10), ' '), 80) AS line FROM documents",
    "row_cap": "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 1000",
    "catalog_listing": _values(
        [("nation", i, c, i == 0) for i, c in enumerate(("n_nationkey", "n_name", "n_regionkey"))] + [("region", i, c, i == 0) for i, c in enumerate(("r_regionkey", "r_name"))],
        "tbl, place, col, in_key",
    ),
    "snapshot_copy": "SELECT * FROM orders",
    "bulk_insert": "SELECT * FROM supplier",
    "gateway_query": "SELECT r_name, count(*) AS nations FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name",
    "store_replay": _LIVE,
    "flagship": f"SELECT event_type, count(*) AS users, max(event_id) AS last_event FROM ({_LIVE}) GROUP BY event_type",
}
