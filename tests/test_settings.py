import pytest

from tidemark.functions import ddl
from tidemark.functions.source_types import is_integer, spark_type, target_name
from tidemark.operators.ranges import Range, as_integer, plan_ranges, split
from tidemark.operators.store import Conflict, add_gtid, merged, with_retry
from tidemark.plans.mirror_queries import STATEMENTS, TYPES
from tidemark.sources.config import Scope, Settings
from tidemark.streaming.changes import start_mode


@pytest.mark.parametrize(("source", "target"), TYPES)
def test_type_names(source, target):
    assert target_name(source) == target


@pytest.mark.parametrize(
    ("source", "safe", "reference"),
    [
        ("int unsigned", "bigint", "int"),
        ("bigint unsigned", "decimal(20,0)", "bigint"),
        ("tinyint unsigned", "smallint", "tinyint"),
        ("mediumint unsigned", "int", "int"),
        ("decimal(12, 2)", "decimal(12,2)", "decimal(38,10)"),
        ("decimal(10)", "decimal(10,0)", "decimal(38,10)"),
        ("datetime(6)", "timestamp_ntz", "timestamp_ntz"),
        ("time", "string", "string"),
        ("blob", "binary", "binary"),
    ],
)
def test_spark_types(source, safe, reference):
    assert spark_type(source).simpleString() == safe
    assert spark_type(source, "reference").simpleString() == reference


def test_wide_decimals_and_empty_types():
    assert spark_type("decimal(65,30)").simpleString() == "string"
    with pytest.raises(ValueError):
        target_name("  ")
    assert is_integer("bigint unsigned") and is_integer("INT(11)") and not is_integer("varchar(64)")


@pytest.mark.parametrize(("sql", "reference", "safe"), STATEMENTS)
def test_statements(sql, reference, safe):
    for mode, expected in (("reference", reference), ("safe", safe)):
        first = (ddl.parse(sql, "demo", mode) or [None])[0]
        assert (first and (first.kind, first.table, first.column)) == expected


def test_lists_of_changes():
    found = ddl.parse("ALTER TABLE `a b`.t ADD COLUMN x decimal(12, 2) NOT NULL COMMENT 'is null', DROP y, ADD z INT COMMENT 'not null' AFTER x", "demo")
    assert [(c.kind, c.schema, c.column, c.type, c.nullable) for c in found] == [
        ("add_column", "a b", "x", "decimal(12, 2)", False),
        ("drop_column", "a b", "y", "", True),
        ("add_column", "a b", "z", "INT", True),
    ]
    assert [(c.table, c.new_table) for c in ddl.parse("RENAME TABLE a TO b, c TO d", "x")] == [("a", "b"), ("c", "d")]
    assert [c.table for c in ddl.parse("DROP TABLE a, `b`", "x")] == ["a", "b"]
    first = ddl.parse("ALTER TABLE t ADD COLUMN a INT COMMENT 'is not null', ADD COLUMN b INT", "x", "reference")
    assert len(first) == 1 and not first[0].nullable


def test_create_columns():
    columns, key = ddl.create_columns("CREATE TABLE users (id BIGINT NOT NULL PRIMARY KEY, name VARCHAR(64) NOT NULL, email VARCHAR(128), PRIMARY KEY (id))")
    assert [(c.name, c.type, c.nullable, c.key) for c in columns] == [("id", "BIGINT", False, True), ("name", "VARCHAR(64)", False, False), ("email", "VARCHAR(128)", True, False)]
    assert key == ["id"]
    columns, key = ddl.create_columns(
        """CREATE TABLE t (key_id INT, `index` ENUM('a,b', 'c)') DEFAULT 'a,b', total DECIMAL(12, 2) UNSIGNED NOT NULL, -- note, (
        CONSTRAINT pk PRIMARY KEY (key_id, `index`), FULLTEXT KEY ft (total), UNIQUE KEY u (total)) ENGINE=x COMMENT='(z)'"""
    )
    assert [c.name for c in columns] == ["key_id", "index", "total"] and key == ["key_id", "index"]
    assert columns[1].type == "ENUM('a,b', 'c)')" and columns[2].type == "DECIMAL(12, 2) UNSIGNED"
    for bad in ("CREATE TABLE t LIKE u", "CREATE TABLE t ()"):
        with pytest.raises(ValueError):
            ddl.create_columns(bad)
    assert ddl.split_list("a INT, b ENUM('x,y'), c DECIMAL(1,2)") == ["a INT", "b ENUM('x,y')", "c DECIMAL(1,2)"]


def test_split():
    assert split(1, 100, 4) == [(1, 26), (26, 51), (51, 76), (76, 100)]
    assert split(1, 2, 4) == [(1, 2), (2, 2)]
    assert split(-5, 2**64, 3)[0][0] == -5 and split(-5, 2**64, 3)[-1][1] == 2**64
    assert plan_ranges(7, 7, "id", 4) == [Range("id", 7, 7, True)]
    for low, high, column, parts in ((None, None, "id", 4), ("x", 9, "id", 4), (1, 9, None, 4), (1, 9, "id", 1)):
        assert plan_ranges(low, high, column, parts) == [Range()]
    ranges = plan_ranges(b"1", "10", "i`d", 3)
    assert [r.sql() for r in ranges] == ["`i``d` >= 1 AND `i``d` < 4", "`i``d` >= 4 AND `i``d` < 7", "`i``d` >= 7 AND `i``d` <= 10"]
    assert [as_integer(v) for v in (42, 99, b"123", "456", "4x", 1.5, True, None)] == [42, 99, 123, 456, None, None, None, None]


@pytest.mark.parametrize(
    ("databases", "allow", "deny", "probes"),
    [
        (["demo"], ["demo.users"], [], {"demo.users": True, "demo.orders": False, "other.users": False}),
        (["demo", "app"], [], ["demo.big_logs", "audit_*", "app.tmp_*"], {"demo.users": True, "demo.big_logs": False, "demo.audit_2024": False, "app.tmp_cache": False, "app.users": True}),
        (["demo"], ["demo.user_*"], ["demo.user_sessions"], {"demo.user_profile": True, "demo.user_sessions": False, "demo.orders": False}),
        (["d"], ["[", "[a-", "x\\", "[^a-c]z", "q?", "\\*"], [], {"d.[": False, "d.dz": True, "d.az": False, "d.qq": True, "d.q": False, "d.*": True, "d.x": False}),
    ],
)
def test_scope(spark, databases, allow, deny, probes):
    from pyspark.sql import functions as F

    scope = Scope(tuple(databases), tuple(allow), tuple(deny))
    assert {p: scope.has(*p.split(".", 1)) for p in probes} == probes
    rows = spark.createDataFrame([tuple(p.split(".", 1)) for p in probes], "d string, t string")
    assert {f"{r.d}.{r.t}": r.ok for r in rows.select("d", "t", scope.column(F.col("d"), F.col("t")).alias("ok")).collect()} == probes


def test_settings(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text("mysql: {user: root, password: x, server_id: 9}\nsync: {databases: [demo], tables: [demo.users]}\nquery_api: {listen: ':8080'}\n")
    found = Settings.load(path)
    assert (found.mysql.addr, found.mysql.server_id, found.sync.batch_size, found.sync.dump_concurrency) == ("127.0.0.1:3306", 9, 1000, 4)
    assert (found.query_api.max_rows, found.query_api.timeout_sec) == (1000, 30) and found.scope.has("demo", "users")
    assert Settings.of({"sync": {"databases": ["a"]}}).query_api.max_rows == 0
    for bad in ({}, {"sync": {"databases": ["a"], "tables": [" "]}}, {"sync": {"databases": ["a"], "exclude_tables": ["a/b"]}}):
        with pytest.raises(ValueError):
            Settings.of(bad)


def test_positions():
    assert add_gtid("a:1-5:9", "a:6-8,B:3") == "a:1-9,b:3" and add_gtid("", "") == ""
    assert merged({"gtid": "a:1"}, {"file": "f", "pos": 4, "gtid": ""}) == {"file": "f", "pos": 4, "gtid": "a:1"}
    assert merged({"gtid": "a:1"}, None) == {"gtid": "a:1"}
    assert [start_mode(p) for p in (None, {"file": "f", "gtid": ""}, {"file": "f", "gtid": "a:1"})] == ["snapshot", "file", "gtid"]


def test_retry():
    tries = []

    def twice():
        tries.append(1)
        if len(tries) < 3:
            raise Conflict("v")
        return "done"

    assert with_retry(twice, wait_s=0) == "done" and len(tries) == 3
    with pytest.raises(Conflict):
        with_retry(lambda: (_ for _ in ()).throw(Conflict("v")), attempts=2, wait_s=0)
