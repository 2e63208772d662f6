"""Which statements the gateway runs: those whose parsed plan only reads.

The text rules of the mirror this engine replaces are kept for parity
(:func:`text_allows`); the gateway itself looks at the whole parsed plan, which neither
literals nor line breaks can fool.
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

#: Statements that the text rules accept and words they refuse between spaces.
OPENERS = ("SELECT", "WITH", "SHOW", "DESCRIBE", "DESC", "EXPLAIN")
REFUSED = (
    "INSERT", "UPDATE", "DELETE", "DROP", "ALTER", "CREATE", "ATTACH", "COPY", "PRAGMA",
    "CALL", "EXECUTE", "INSTALL", "LOAD", "EXPORT", "IMPORT", "VACUUM", "FORCE",
)

#: Plan nodes that change nothing, as Spark's parser names them.
READING = {
    "Project", "Filter", "Aggregate", "Sort", "GlobalLimit", "LocalLimit", "LimitAll", "Limit", "Offset", "Tail", "Distinct", "Union", "Intersect", "Intersect All", "Except", "Except All",
    "Join", "LateralJoin", "SubqueryAlias", "UnresolvedSubqueryColumnAliases", "UnresolvedRelation", "UnresolvedInlineTable", "OneRowRelation", "Range",
    "UnresolvedWith", "WithCTE", "CTERelationDef", "CTERelationRef", "UnresolvedCTERelationPlans", "Generate", "Window", "WithWindowDefinition", "Pivot", "Unpivot",
    "UnresolvedHaving", "Sample", "LocalRelation", "UnresolvedTableValuedFunction", "UnresolvedTVFAliases", "Expand", "UnresolvedHint",
    "UnionLoop", "UnionLoopRef", "RepartitionByExpression", "RebalancePartitions", "Subquery", "AsOfJoin", "UnresolvedOrdinal", "PipeExpression",
    "ShowTables", "ShowColumns", "ShowNamespaces", "ShowNamespacesCommand", "DescribeRelation", "DescribeQueryCommand", "ExplainCommand", "UnresolvedTableOrView", "UnresolvedNamespace", "CurrentNamespace",
}
#: Formats whose files Spark reads by path in the place of a table.
FORMATS = {"csv", "json", "parquet", "orc", "text", "avro", "xml", "binaryfile", "image", "libsvm", "jdbc", "delta", "iceberg", "hudi"}
#: Built-in functions that run any method of the virtual machine.
CALLS = {"reflect", "java_method", "try_reflect"}
#: Table functions that make rows from their arguments alone.
TABLE_FUNCTIONS = {"range", "explode", "explode_outer", "posexplode", "posexplode_outer", "inline", "inline_outer", "stack", "sequence", "json_tuple"}
#: Expressions whose function is named by a value, so that the text does not show it.
NAMED_LATER = {"ExpressionWithUnresolvedIdentifier", "PythonUDF", "ScalaUDF", "CallMethodViaReflection", "TryReflect"}
_LEXED = re.compile(r"""'(?:[^'\\]|\\.|'')*'|--[^\n]*|/\*.*?\*/|(?P<name>"(?:[^"]|"")*"|`(?:[^`]|``)*`|[^\W\d]\w*)(?=(?P<call>(?:\s|--[^\n]*\n|/\*.*?\*/)*\())?""", re.S)


class Refused(ValueError):
    """A statement that the gateway does not run."""


def text_allows(sql: str) -> bool:
    """The text rules: one statement, a known opening, none of the refused words between spaces."""
    text = sql.strip().rstrip("; \t\r\n")
    if not text or ";" in text:
        return False
    while text.startswith(("--", "/*")):
        head, _, rest = text.partition("\n" if text.startswith("--") else "*/")
        if not rest:
            return False
        text = rest.strip()
    upper = text.upper()
    return upper.startswith(OPENERS) and not any(f" {w} " in f" {upper} " for w in REFUSED)


def _items(found):
    return [found.apply(i) for i in range(found.size())]


def _walk(plan):
    todo = [plan]
    while todo:
        node = todo.pop()
        yield node
        for group in (node.children(), node.innerChildren()):
            for child in _items(group):
                if hasattr(child, "children") and "logical" in child.getClass().getName() or "analysis" in child.getClass().getName():
                    todo.append(child)
        name = node.nodeName()
        if name == "ExplainCommand":
            todo.append(node.logicalPlan())
        elif name == "DescribeQueryCommand":
            todo.append(node.plan())
        todo += _items(node.subqueries())


def _expressions(node):
    """All expressions of a plan node, and those within them."""
    todo = _items(node.expressions())
    if node.nodeName().strip("'$") == "WithWindowDefinition":  # kept in a map, which expressions() leaves out
        todo += _items(node.windowDefinitions().values().toSeq())
    while todo:
        one = todo.pop()
        yield one
        todo += _items(one.children())


def _built_in(spark: SparkSession) -> set[str]:
    known = spark._jvm.org.apache.spark.sql.catalyst.analysis.FunctionRegistry.builtin().listFunction()
    return {f.funcName().lower() for f in _items(known)}


def _calls(sql: str) -> set[str]:
    """The names before an opening parenthesis, outside literals and comments."""
    return {m["name"].strip("`\"").lower() for m in _LEXED.finditer(sql) if m["name"] and m["call"]}


def check(spark: SparkSession, sql: str) -> None:
    """Raise Refused unless every node of the statement's plan only reads registered tables."""
    text = sql.strip()
    while text.endswith(";"):
        text = text[:-1].rstrip()
    if not text:
        raise Refused("empty statement")
    sessions = SparkSession._get_j_spark_session_class(spark._jvm)
    before = sessions.getActiveSession()
    try:
        sessions.setActiveSession(spark._jsparkSession)  # the parser takes its settings from the active session
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    except Exception as e:
        raise Refused(str(getattr(e, "desc", None) or getattr(e, "java_exception", None) or e).split("\n")[0]) from None
    finally:
        if before.isDefined():
            sessions.setActiveSession(before.get())
    if _calls(text) & CALLS:
        raise Refused("calls into the virtual machine are not allowed")
    allowed: set[str] = set()
    for node in _walk(plan):
        name = node.nodeName().strip("'$")
        if name not in READING:
            raise Refused(f"only queries are allowed, not {name}")
        if name == "UnresolvedRelation":
            parts = node.multipartIdentifier()
            names = [parts.apply(i) for i in range(parts.size())]
            if any("/" in n or "\\" in n or ":" in n for n in names) or (len(names) > 1 and names[0].lower() in FORMATS):
                raise Refused("files cannot be read by path")
        if name == "Join" and "POSITIONAL" in text.upper() and re.search(r"\bPOSITIONAL\s+JOIN\b", text, re.I):
            raise Refused("positional joins are not supported")
        if name == "UnresolvedTableValuedFunction":
            called = [str(x).lower() for x in _items(node.name())]
            if len(called) != 1 or called[0] not in TABLE_FUNCTIONS:
                raise Refused("this table function is not allowed")
        for one in _expressions(node):
            kind = one.getClass().getSimpleName()
            if kind in NAMED_LATER:
                raise Refused("functions have to be called by their names")
            if kind == "UnresolvedFunction":
                allowed = allowed or _built_in(spark) - CALLS
                called = [str(x).lower() for x in _items(one.nameParts())]
                if called[-1] not in allowed or len(called) > 1:
                    raise Refused(f"the function {'.'.join(called)} is not allowed")
