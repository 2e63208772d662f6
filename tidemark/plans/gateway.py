"""Read-only SQL over the mirrored tables: check, run, cap, and make JSON of the rows."""

from __future__ import annotations

import re
import threading
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.values import to_json
from tidemark.plans import readonly
from tidemark.plans.lateral import ordered_first

MAX_ROWS = 1000
TIMEOUT_S = 30.0


@dataclass
class Result:
    columns: list[str]
    rows: list[dict]
    seconds: float

    def to_json(self) -> dict:
        return {"columns": self.columns, "rows": self.rows, "rowCount": len(self.rows), "durationMs": int(self.seconds * 1000)}


#: Words that may follow a table and are not its alias.
_AFTER = set(
    """WHERE GROUP ORDER LIMIT JOIN INNER LEFT RIGHT FULL CROSS SEMI ANTI NATURAL ON USING UNION INTERSECT EXCEPT MINUS HAVING WINDOW OFFSET
    LATERAL PIVOT UNPIVOT TABLESAMPLE SORT CLUSTER DISTRIBUTE SELECT""".split()
)
_WORD = r'"(?:[^"]|"")*"|`(?:[^`]|``)*`|[^\W\d]\w*'
_NAMES = re.compile(rf"""'(?:[^'\\]|\\.|'')*'|--[^\n]*|/\*.*?\*/|(?<![\w.])(?P<schema>{_WORD})\s*\.\s*(?P<table>{_WORD})(?P<more>\s*\.)?(?=(?:\s+(?P<next>{_WORD}))?)|{_WORD}""", re.S)
_SHOW_SCHEMAS = re.compile(r"SHOW\s+(?:DATABASES|SCHEMAS)", re.I)


def _plain(word: str) -> str:
    return word[1:-1].replace(word[0] * 2, word[0]) if word[:1] in '"`' else word


def unqualified(sql: str, known: dict[tuple[str, str], str]) -> str:
    """``schema.table`` as the name of the table's view, under the table's own name unless an alias follows."""

    def one(m: re.Match) -> str:
        if m["schema"] is None:
            return m[0]
        table = _plain(m["table"])
        view = known.get((_plain(m["schema"]), table))
        if view is None:
            return m[0]
        quoted = lambda name: '"' + name.replace('"', '""') + '"'
        if m["more"]:
            return quoted(table) + "."  # a column of the table
        aliased = m["next"] is not None and m["next"].upper() not in _AFTER
        return quoted(view) if aliased or view == table else f"{quoted(view)} AS {quoted(table)}"

    return _NAMES.sub(one, sql)


class Gateway:
    """Runs checked statements in a session of its own, with double-quoted identifiers.

    Without a catalog it sees the temporary views that the given session has now.  With one,
    every statement reads the latest versions of the tables it names, as ``schema_table`` or
    ``schema.table``.
    """

    def __init__(self, spark: SparkSession, catalog=None, max_rows: int = MAX_ROWS, timeout_s: float = TIMEOUT_S):
        self.spark = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
        self.catalog, self.max_rows, self.timeout_s = catalog, max_rows if max_rows > 0 else MAX_ROWS, timeout_s if timeout_s > 0 else TIMEOUT_S
        self.spark.conf.set("spark.sql.ansi.enabled", "true")
        self.spark.conf.set("spark.sql.ansi.doubleQuotedIdentifiers", "true")
        self.spark.conf.set("spark.sql.runSQLOnFiles", "false")
        self.lock = threading.Lock()
        if catalog is not None:
            from tidemark.operators.store import Catalog

            self.catalog = Catalog(self.spark, catalog.root, catalog.name, catalog.target_schema)

    def refresh(self) -> dict[tuple[str, str], str]:
        """Bind the views to the latest versions; queries under way keep theirs."""
        if self.catalog is None:
            return {}
        from tidemark.operators.store import view_name

        tables = self.catalog.tables()
        views = {t: view_name(*t) for t in tables}
        for old in self.views - set(views.values()):
            self.spark.catalog.dropTempView(old)
        self.views = set(self.catalog.register())
        return views

    views: set[str] = set()

    def limit(self, wanted: int | None) -> int:
        return self.max_rows if not wanted or wanted < 0 or wanted > self.max_rows else wanted

    def frame(self, sql: str, limit: int | None = None) -> DataFrame:
        """The checked and capped query, not yet run.  The cap is part of the plan, so scans stop early."""
        readonly.check(self.spark, sql)
        text = sql.strip()
        while text.endswith(";"):
            text = text[:-1].rstrip()
        with self.lock:  # a plan is bound to the views at once, so a later refresh does not touch it
            known = self.refresh()
            if self.catalog is not None and _SHOW_SCHEMAS.fullmatch(text):
                schemas = sorted({s for s, _ in known})
                return self.spark.createDataFrame([(s,) for s in schemas], "namespace string").limit(self.limit(limit))
            return ordered_first(self.spark.sql(unqualified(text, known))).limit(self.limit(limit))

    def query(self, sql: str, limit: int | None = None) -> Result:
        """Run one statement; TimeoutError when it takes too long.  Of columns of one name the last counts."""
        began, tag, late = time.time(), f"gateway-{uuid.uuid4().hex}", threading.Event()
        context = self.spark.sparkContext

        def stop() -> None:
            late.set()
            context.cancelJobsWithTag(tag)

        timer = threading.Timer(self.timeout_s, stop)
        context.addJobTag(tag)
        context.setInterruptOnCancel(True)
        timer.start()
        try:
            frame = self.frame(sql, limit)
            rows = [{c: to_json(v) for c, v in zip(frame.columns, r, strict=True)} for r in frame.collect()]
        except readonly.Refused:
            raise
        except Exception as e:
            if late.is_set():
                raise TimeoutError(f"the query took more than {self.timeout_s:g} s") from e
            raise
        finally:
            timer.cancel()
            context.setInterruptOnCancel(False)
            context.removeJobTag(tag)
        return Result(frame.columns, rows, time.time() - began)
