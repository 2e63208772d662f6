import datetime as dt
import decimal
import json
import random
import urllib.error
import urllib.request

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.values import rfc3339, to_json, wall_clock
from tidemark.operators import apply as ops
from tidemark.operators.store import Catalog, Conflict
from tidemark.plans import readonly
from tidemark.plans.gateway import Gateway
from tidemark.plans.mirror_queries import READONLY
from tidemark.plans.server import Server
from tidemark.sources.config import Scope, Settings
from tidemark.sources.snapshot import ParquetSource, snapshot
from tidemark.streaming.changes import CHANGELOG, Applier, batches, stream

USERS = T.StructType().add("id", T.LongType(), False).add("name", T.StringType(), False)


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=str)


@pytest.fixture
def catalog(spark, tmp_path):
    return Catalog(spark, f"file://{tmp_path}/tables")


def test_rows_and_columns(spark, catalog):
    catalog.create("demo", "users", USERS, ["id"], 3)
    of = lambda *v: spark.createDataFrame(list(v), "id bigint, name string")
    catalog.insert("demo", "users", of((1, "alice"), (2, "bob")))
    with pytest.raises(ValueError):
        catalog.insert("demo", "users", of((2, "again")))
    catalog.upsert("demo", "users", of((1, "ALICE")).withColumn("n", F.lit(1)), "n")
    catalog.delete("demo", "users", of((2, "anything"), (7, None)))
    assert rows(catalog.read("demo", "users")) == [(1, "ALICE")]
    before = catalog.get("demo", "users").version
    catalog.add_column("demo", "users", "age", T.IntegerType())
    assert rows(catalog.read("demo", "users")) == [(1, "ALICE", None)] and rows(catalog.read("demo", "users", before)) == [(1, "ALICE")]
    catalog.drop_column("demo", "users", "name")
    catalog.add_column("demo", "users", "name", T.StringType())
    assert rows(catalog.read("demo", "users")) == [(1, None, None)]
    with pytest.raises(ValueError):
        catalog.drop_column("demo", "users", "id")
    catalog.rename("demo", "users", "people")
    assert catalog.get("demo", "users") is None and rows(catalog.read("demo", "people")) == [(1, None, None)]
    assert catalog.tables() == [("demo", "people")]
    catalog.expire("demo", "people", 1)
    assert rows(catalog.read("demo", "people")) == [(1, None, None)]
    catalog.truncate("demo", "people")
    assert catalog.read("demo", "people").count() == 0
    catalog.drop("demo", "people")
    with pytest.raises(LookupError):
        catalog.read("demo", "people")
    catalog.create("demo", "people", USERS, ["id"])
    assert catalog.read("demo", "people").columns == ["id", "name"]


def test_catalog_names_and_conflicts(spark, catalog):
    made = catalog.create("mirror", "t1", T.StructType().add("id", T.LongType(), False), ["id"])
    assert catalog.tables() == [("main", "t1")]
    catalog.load("mirror", "t1", spark.range(1))
    assert rows(catalog.read("mirror", "t1")) == [(0,)]
    with pytest.raises(Conflict):
        catalog.commit(made, "mirror", "t1")
    with pytest.raises(ValueError):
        catalog.load("mirror", "t1", spark.createDataFrame([(1,), (1,)], "id bigint"))
    catalog.create("demo", "nokey", USERS, [])
    with pytest.raises(ValueError):
        catalog.upsert("demo", "nokey", spark.createDataFrame([(1, "a", 1)], "id bigint, name string, n int"), "n")


def history(rng, n):
    """Random changes: (seq, kind, before, after) over a few keys, updates that move keys among them."""
    live, out = {}, []
    for seq in range(n):
        free = [k for k in range(6) if k not in live]
        kind = rng.choice(["insert"] * bool(free) + ["update", "delete"] * bool(live))
        if kind == "insert":
            row = (rng.choice(free), f"v{seq}")
            out.append((seq, kind, None, row))
            live[row[0]] = row
        else:
            old = live.pop(rng.choice(sorted(live)))
            row = (rng.choice([old[0], *free]), f"v{seq}")
            out.append((seq, kind, old, row if kind == "update" else None))
            if kind == "update":
                live[row[0]] = row
    return out, sorted(live.values())


def replay(changes, safe):
    state = {}
    for _, kind, before, after in changes:
        if kind == "delete" or (kind == "update" and safe and before[0] != after[0]):
            state.pop(before[0], None)
        if kind != "delete":
            state[after[0]] = after
    return sorted(state.values())


def log_of(spark, changes):
    image = lambda r: json.dumps({"id": r[0], "name": r[1]}) if r else None
    data = [(s, "f", s, f"u:{s + 1}", "demo", "users", k, image(b), image(a), None) for s, k, b, a in changes]
    return spark.createDataFrame(data, CHANGELOG)


@pytest.mark.parametrize(("seed", "mode"), [(1, "safe"), (2, "safe"), (3, "reference")])
def test_batches_replays_and_restarts(spark, tmp_path, seed, mode):
    rng = random.Random(seed)
    changes, truth = history(rng, 60)
    log = log_of(spark, changes).cache()
    expected = replay(changes, mode == "safe")
    assert mode == "reference" or expected == truth
    cuts = sorted(rng.sample(range(60), 3))
    catalog = Catalog(spark, f"file://{tmp_path}/t")
    catalog.create("demo", "users", USERS, ["id"], 2)
    applier = Applier(catalog, Scope(("demo",)), mode)
    for number, part in enumerate(batches(log, cuts)):
        applier.run(part, number)
        applier.run(part, number)  # delivered twice
    applier.run(log.where(F.col("seq") >= cuts[1]))  # and from an earlier position
    assert rows(catalog.read("demo", "users")) == expected
    assert catalog.get("demo", "users").position == {"file": "f", "pos": 59, "gtid": "u:1-60", "seq": 59}


def test_fold_is_the_sequence(spark):
    rng = random.Random(5)
    for _ in range(4):
        changes, _ = history(rng, 40)
        pairs = [(s, b or (None, None), a or (None, None), k) for s, k, b, a in changes]
        typed = spark.createDataFrame(pairs, "seq bigint, before struct<id:bigint,name:string>, after struct<id:bigint,name:string>, kind string")
        put = ops.changes(typed.where("kind = 'insert'").select("after.*", F.col("seq").alias("s")), ops.PUT, "s", 1).drop("s")
        gone = ops.changes(typed.where("kind = 'delete'").select("before.*", F.col("seq").alias("s")), ops.DELETE, "s", 1).drop("s")
        moved = ops.updates(typed.where("kind = 'update'"), ["id", "name"], ["id"], "before", "after", "seq", True)
        base = spark.createDataFrame([], "id bigint, name string")
        assert rows(ops.apply(base, put.unionByName(gone).unionByName(moved), ["id"])) == replay(changes, True)
    with pytest.raises(ValueError):
        ops.fold(base, [])


def test_stream_with_schema_changes(spark, tmp_path):
    def line(seq, kind, before=None, after=None, sql=None, tbl="users"):
        return {"seq": seq, "file": "f", "pos": seq, "gtid": f"u:{seq}", "db": "demo", "tbl": tbl, "kind": kind, "before": before and json.dumps(before), "after": after and json.dumps(after), "ddl_sql": sql}

    log = [
        line(1, "ddl", sql="CREATE TABLE users (id BIGINT PRIMARY KEY, name VARCHAR(20))"),
        line(2, "insert", after={"id": 1, "name": "a"}),
        line(3, "insert", after={"id": 2, "name": "b"}),
        line(4, "ddl", sql="ALTER TABLE users ADD COLUMN age INT, DROP COLUMN name"),
        line(5, "update", {"id": 1}, {"id": 3, "age": 7}),
        line(6, "insert", after={"id": 9}, tbl="secret"),
        line(7, "ddl", sql="RENAME TABLE users TO people"),
        line(8, "delete", {"id": 2}, tbl="people"),
        line(9, "ddl", sql="DROP TABLE secret"),
    ]
    folder = tmp_path / "log"
    folder.mkdir()
    (folder / "1.json").write_text("\n".join(map(json.dumps, log)))
    catalog = Catalog(spark, f"file://{tmp_path}/t")
    applier = Applier(catalog, Scope(("demo",), (), ("secret",)))
    for _ in range(2):
        stream(spark, f"file://{folder}", applier, f"file://{tmp_path}/cp").awaitTermination()
        assert catalog.tables() == [("demo", "people")]
        assert rows(catalog.read("demo", "people")) == [(3, 7)]
    (folder / "2.json").write_text(json.dumps(line(10, "ddl", sql="TRUNCATE people")) + "\n" + json.dumps(line(11, "insert", after={"id": 5, "age": 1}, tbl="people")))
    stream(spark, f"file://{folder}", applier, f"file://{tmp_path}/cp").awaitTermination()
    assert rows(catalog.read("demo", "people")) == [(5, 1)]


def test_snapshot(spark, tmp_path, sf_dir):
    catalog = Catalog(spark, f"file://{tmp_path}/t")
    keys = {"nation": ["n_nationkey"], "orders": ["o_orderkey"]}
    made = snapshot(catalog, ParquetSource(spark, sf_dir, "demo", keys, {"file": "f", "pos": 1, "gtid": ""}), 4)
    assert set(made) == {("demo", "nation"), ("demo", "orders")}
    assert rows(catalog.read("demo", "orders")) == rows(spark.read.parquet(f"{sf_dir}/orders.parquet"))
    version = catalog.get("demo", "nation").version
    with pytest.raises(Exception, match="duplicate"):
        snapshot(catalog, ParquetSource(spark, sf_dir, "demo", {"nation": ["n_regionkey"], "lineitem": ["l_orderkey"]}))
    assert catalog.get("demo", "nation").version == version or catalog.read("demo", "nation").count() == 25


def test_progress(spark):
    from tidemark.sources.progress import Watch, percent

    assert [percent(0, 0), percent(1, 3), percent(3, 3), percent(3, 3, True)] == [0.0, 33.3, 99.9, 100.0]
    with Watch(spark, "t", 10, 0.01) as watch:
        spark.range(10).repartition(2).count()
        done, total = watch.shares()
    assert 0 < done <= total


def test_engine(spark, tmp_path, sf_dir):
    from tidemark.engine import Engine

    settings = Settings.of({"sync": {"databases": ["demo"], "checkpoint_path": f"{tmp_path}/cp"}, "duckdb": {"path": f"file://{tmp_path}/t"}, "query_api": {"listen": "127.0.0.1:0"}})
    source = ParquetSource(spark, sf_dir, "demo", {"nation": ["n_nationkey"]}, {"file": "f", "pos": 1, "gtid": ""})
    with Engine(spark, settings, source) as engine:
        engine.run()
        assert engine.position()["file"] == "f"
        body = json.dumps({"sql": "SELECT count(*) AS n FROM demo_nation"}).encode()
        with urllib.request.urlopen(urllib.request.Request(f"{engine.server.address}/v1/sql/query", body)) as answer:
            assert json.load(answer)["rows"] == [{"n": 25}]


@pytest.mark.parametrize(("sql", "by_text", "by_plan"), READONLY)
def test_readonly(spark, sql, by_text, by_plan):
    assert readonly.text_allows(sql) == by_text
    if by_plan:
        readonly.check(spark, sql)
    else:
        with pytest.raises(readonly.Refused):
            readonly.check(spark, sql)


@pytest.mark.parametrize("sql", ["SELECT (SELECT max(a) FROM csv.`data`)", "SELECT * FROM a WHERE x IN (SELECT y FROM parquet.`/tmp/x`)", "SELECT * FROM a POSITIONAL JOIN b", "SELECT * FROM python_worker_logs()", "EXPLAIN EXTENDED INSERT INTO t SELECT 1", "CREATE TABLE t AS SELECT 1", "FROM t INSERT INTO u SELECT *", "CALL x()"])
def test_readonly_refuses_nested(spark, sql):
    with pytest.raises(readonly.Refused):
        readonly.check(spark, sql)


def test_values():
    zone = dt.timezone(dt.timedelta(hours=8))
    at = dt.datetime(2026, 9, 25, 7, 49, tzinfo=zone)
    assert str(wall_clock(at)) == "2026-09-25 07:49:00" and rfc3339(at) == "2026-09-24T23:49:00Z"
    assert rfc3339(dt.datetime(2020, 1, 2, 3, 4, 5, 120000)) == "2020-01-02T03:04:05.12Z"
    assert [to_json(decimal.Decimal(v)) for v in ("1.50", "7", "9223372036854775808")] == [1.5, 7, "9223372036854775808"]
    assert to_json(b"ab") == "ab" and to_json(None) is None and to_json([{"a": decimal.Decimal("1.5")}]) == [{"a": 1.5}]


@pytest.fixture(scope="module")
def server(spark):
    spark.range(2000).createOrReplaceTempView("numbers")
    made = Server(Gateway(spark, max_rows=50, timeout_s=3), "127.0.0.1:0", "secret").start()
    yield made
    made.stop()
    for name in ("spark.sql.ansi.doubleQuotedIdentifiers", "spark.sql.runSQLOnFiles"):
        spark.conf.unset(name)


def ask(server, body, token="Bearer secret", path="/v1/sql/query"):
    request = urllib.request.Request(server.address + path, body if body is None or isinstance(body, bytes) else json.dumps(body).encode(), {"Authorization": token} if token else {})
    try:
        with urllib.request.urlopen(request) as answer:
            return answer.status, json.load(answer)
    except urllib.error.HTTPError as e:
        return e.code, json.load(e)


def test_server(server):
    assert ask(server, None, None, "/healthz") == (200, {"ok": True})
    assert ask(server, {"sql": "SELECT 1"}, None)[0] == 401 and ask(server, {"sql": "SELECT 1"}, "Bearer x")[0] == 401
    status, found = ask(server, {"sql": 'SELECT "id" FROM numbers ORDER BY id;', "limit": 3}, "secret")
    assert status == 200 and found["rows"] == [{"id": 0}, {"id": 1}, {"id": 2}] and found["rowCount"] == 3 and found["durationMs"] >= 0
    for limit in (0, -1, 51, None):
        assert ask(server, {"sql": "SELECT id FROM numbers", "limit": limit})[1]["rowCount"] == 50
    for bad in ({"sql": "SELECT 1", "x": 1}, {"sql": " "}, {"sql": "DROP TABLE numbers"}, {"sql": "SELECT nothing FROM numbers"}, b"{", {"sql": 3}):
        assert ask(server, bad)[0] == 400
    status, found = ask(server, {"sql": "SELECT 1 AS a, 2 AS a"})
    assert found["columns"] == ["a", "a"] and found["rows"] == [{"a": 2}]
    assert ask(server, {"sql": "SELECT 1"}, path="/nothing")[0] == 404


def test_server_deadline(server):
    slow = "SELECT count(*) FROM range(100000000000) a WHERE sqrt(a.id) % 7 = 3"
    assert ask(server, {"sql": slow})[0] == 504


@pytest.mark.parametrize(
    "sql",
    [
        "SELECT " + ", ".join(f"{i} AS c{i}" for i in range(40)) + ", reflect('java.lang.System', 'getProperty', 'user.home')",
        "SELECT `reflect` ('java.lang.System', 'exit', 0)",
        "SELECT try_reflect/* x */('java.lang.System', 'exit', 0)",
        "SELECT sum(1) OVER w FROM t WINDOW w AS (ORDER BY java_method('java.lang.System', 'exit', 0))",
        "SELECT * FROM VALUES (reflect('java.lang.System', 'exit', 0))",
        "SELECT IDENTIFIER('ref' || 'lect')('java.lang.System', 'exit', 0)",
        "SELECT a FROM t WHERE EXISTS (SELECT nothing_known(1))",
    ],
)
def test_readonly_refuses_calls(spark, sql):
    with pytest.raises(readonly.Refused):
        readonly.check(spark, sql)


def test_readonly_takes_names_in_text(spark):
    readonly.check(spark, "SELECT 'reflect(1)' AS a, reflect AS b, upper('x') AS c FROM t -- reflect('x')")
    readonly.check(spark, "SHOW DATABASES")


def change(seq, kind, after=None, sql=None, tbl="a", gtid=None):
    return (seq, "f", seq, gtid or f"u:{seq}", "demo", tbl, kind, None, after and json.dumps(after), sql)


def test_replay_after_rename_and_drop(spark, catalog):
    made = "CREATE TABLE {} (id BIGINT PRIMARY KEY, name VARCHAR(9))"
    log = [
        change(1, "ddl", sql=made.format("a")), change(2, "insert", {"id": 1, "name": "x"}), change(3, "ddl", sql="RENAME TABLE a TO b"),
        change(4, "insert", {"id": 2, "name": "y"}, tbl="b"), change(5, "ddl", sql=made.format("c")), change(6, "insert", {"id": 1, "name": "z"}, tbl="c"),
        change(7, "ddl", sql="DROP TABLE c"), change(8, "strange", {"id": 9}, tbl="b"), change(9, "ddl", sql="DROP TEMPORARY TABLE b"),
    ]
    batch = spark.createDataFrame(log, CHANGELOG)
    applier = Applier(catalog, Scope(("demo",)))
    counts = [applier.run(batch) for _ in range(3)]
    assert counts == [3, 0, 0]
    assert catalog.tables() == [("demo", "b")] and rows(catalog.read("demo", "b")) == [(1, "x"), (2, "y")]


def test_old_log_over_a_newer_snapshot(spark, catalog, tmp_path):
    spark.createDataFrame([(i, f"n{i}") for i in range(5)], "id bigint, name string").write.parquet(f"{tmp_path}/src/users.parquet")
    source = ParquetSource(spark, f"file://{tmp_path}/src", "demo", {"users": ["id"]}, {"file": "", "pos": 0, "gtid": "u:1-100"})
    snapshot(catalog, source, 2)
    log = [
        change(1, "ddl", sql="TRUNCATE TABLE users", tbl="users", gtid="u:50"), change(2, "insert", {"id": 0, "name": "old"}, tbl="users", gtid="u:51"),
        change(3, "insert", {"id": 7, "name": "new"}, tbl="users", gtid="u:101"),
    ]
    applier = Applier(catalog, Scope(("demo",)))
    for _ in range(2):
        applier.run(spark.createDataFrame(log, CHANGELOG))
        assert rows(catalog.read("demo", "users")) == [(0, "n0"), (1, "n1"), (2, "n2"), (3, "n3"), (4, "n4"), (7, "new")]
    assert catalog.get("demo", "users").position["gtid"] == "u:1-101"


def test_gateway_reads_the_latest_version(spark, catalog):
    catalog.create("main", "order", USERS, ["id"], 2)
    catalog.create("demo", "users", USERS, ["id"], 2)
    of = lambda n: spark.createDataFrame([(i, f"n{i}", i) for i in range(n)], "id bigint, name string, n int")
    catalog.upsert("main", "order", of(3), "n")
    before = spark.conf.get("spark.sql.ansi.doubleQuotedIdentifiers")
    gateway = Gateway(spark, catalog)
    count = 'select count(*) AS n from main."order"'
    assert gateway.query(count).rows == [{"n": 3}]
    catalog.upsert("main", "order", of(9), "n")
    catalog.upsert("demo", "users", of(4), "n")
    assert gateway.query(count).rows == [{"n": 9}]
    joined = "SELECT users.name AS name, 'demo.users' AS t FROM demo.users JOIN main.order o ON users.id = o.id WHERE demo.users.id > 2"
    assert gateway.query(joined).rows == [{"name": "n3", "t": "demo.users"}]
    assert gateway.query("SELECT max(u.id) AS m FROM demo.users AS u").rows == [{"m": 3}]
    assert gateway.query("SHOW DATABASES").rows == [{"namespace": "demo"}, {"namespace": "main"}]
    catalog.drop("demo", "users")
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        gateway.query("SELECT 1 FROM demo_users")
    assert spark.conf.get("spark.sql.ansi.doubleQuotedIdentifiers") == before
    with pytest.raises(TimeoutError):
        Gateway(spark, catalog, timeout_s=1).query("SELECT count(*) FROM range(100000000000) a WHERE sqrt(a.id) % 7 = 3")


def test_buckets_follow_the_rows(spark, catalog, monkeypatch):
    from tidemark.operators import store

    monkeypatch.setattr(store, "BUCKET_ROWS", 100)
    catalog.create("demo", "t", T.StructType().add("id", T.LongType(), False), ["id"])
    assert catalog.load("demo", "t", spark.range(500), about=500).buckets == store.FIRST_BUCKETS
    assert catalog.load("demo", "t", spark.range(5000), about=5000).buckets == 50
    catalog.insert("demo", "t", spark.range(5000, 9000))
    assert catalog.rebucket("demo", "t").buckets == 90 and catalog.read("demo", "t").distinct().count() == 9000


def test_engine_follows_and_serves(spark, tmp_path, sf_dir):
    import time

    from tidemark.engine import Engine

    settings = Settings.of({"sync": {"databases": ["demo"], "checkpoint_path": f"file://{tmp_path}/cp"}, "duckdb": {"path": f"file://{tmp_path}/t"}, "query_api": {"listen": "127.0.0.1:0"}})
    source = ParquetSource(spark, sf_dir, "demo", {"region": ["r_regionkey"]}, {"file": "f", "pos": 1, "gtid": ""})
    (tmp_path / "log").mkdir()
    ask_rows = json.dumps({"sql": "SELECT count(*) AS n FROM demo.region"}).encode()
    with Engine(spark, settings, source) as engine:
        engine.run(f"file://{tmp_path}/log", follow=True)
        line = dict(zip(CHANGELOG.names, change(5, "insert", {"r_regionkey": 77, "r_name": "NEW"}, tbl="region"), strict=True))
        (tmp_path / "log" / "1.json").write_text(json.dumps(line))
        for _ in range(60):
            with urllib.request.urlopen(urllib.request.Request(f"{engine.server.address}/v1/sql/query", ask_rows)) as answer:
                found = json.load(answer)["rows"]
            if found == [{"n": 6}]:
                break
            time.sleep(0.5)
        assert found == [{"n": 6}] and engine.position()["seq"] == 5
    assert not engine.query.isActive


def test_jdbc_source_by_a_stub(spark, monkeypatch):
    from tidemark.operators.ranges import Range
    from tidemark.sources.snapshot import JdbcSource

    asked = []

    def query(self, sql):
        asked.append(sql)
        if "information_schema.COLUMNS" in sql:
            return spark.createDataFrame([("name", "varchar(9)", "YES", "", 2), ("id", "bigint unsigned", "NO", "PRI", 1)], "n string, t string, o string, k string, p int")
        if "TABLE_ROWS" in sql:
            return spark.createDataFrame([(12,)], "n long")
        if "gtid_executed" in sql:
            return spark.createDataFrame([("u:1-5,\nv:1",)], "g string")
        if "MIN(" in sql:
            return spark.createDataFrame([("1", "9")], "a string, b string")
        return spark.createDataFrame([("users",), ("audit",)], "n string")

    monkeypatch.setattr(JdbcSource, "query", query)
    source = JdbcSource(spark, Settings.of({"sync": {"databases": ["de'mo"]}}).mysql, Scope(("de'mo",), (), ("audit",)))
    (table,) = source.tables()
    assert (table.name, table.key, [f.dataType.simpleString() for f in table.struct]) == ("users", ("id",), ["decimal(20,0)", "string"])
    assert source.ranges(table, 2) == [Range("id", 1, 5, False), Range("id", 5, 9, True)]
    assert source.estimated_rows(table) == 12 and source.position() == {"file": "", "pos": 0, "gtid": "u:1-5,v:1"}
    assert any("'de''mo'" in q for q in asked)
