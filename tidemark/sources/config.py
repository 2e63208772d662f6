"""Settings: a YAML file, defaults, validation, and which tables are in scope."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, fields
from functools import lru_cache
from pathlib import Path

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass
class Source:
    addr: str = "127.0.0.1:3306"
    user: str = "root"
    password: str = ""
    server_id: int = 1001
    flavor: str = "mysql"
    charset: str = "utf8mb4"


@dataclass
class Target:
    path: str = "./data/sync.duckdb"


@dataclass
class Sync:
    databases: list[str] = field(default_factory=list)
    tables: list[str] = field(default_factory=list)
    exclude_tables: list[str] = field(default_factory=list)
    checkpoint_path: str = "./data/checkpoint.json"
    batch_size: int = 1000
    dump_concurrency: int = 4


@dataclass
class QueryApi:
    listen: str = ""
    token: str = ""
    max_rows: int = 0
    timeout_sec: int = 0


@dataclass
class Settings:
    mysql: Source = field(default_factory=Source)
    duckdb: Target = field(default_factory=Target)
    sync: Sync = field(default_factory=Sync)
    query_api: QueryApi = field(default_factory=QueryApi)

    @classmethod
    def load(cls, path: str | Path) -> Settings:
        import yaml

        raw = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}
        if not isinstance(raw, dict):
            raise ValueError("the settings file has to hold a mapping")
        return cls.of(raw)

    @classmethod
    def of(cls, raw: dict) -> Settings:
        """Empty and zero values count as missing and take the default; unknown keys are ignored."""
        made = {}
        for section in fields(cls):
            kind = section.default_factory
            given = raw.get(section.name) or {}
            names = {f.name for f in fields(kind)}
            made[section.name] = kind(**{k: v for k, v in given.items() if k in names and v not in (None, "", 0)})
        settings = cls(**made)
        if settings.query_api.listen:
            settings.query_api.max_rows = settings.query_api.max_rows if settings.query_api.max_rows > 0 else 1000
            settings.query_api.timeout_sec = settings.query_api.timeout_sec if settings.query_api.timeout_sec > 0 else 30
        for name, least in (("batch_size", 1000), ("dump_concurrency", 4)):
            if getattr(settings.sync, name) <= 0:
                setattr(settings.sync, name, least)
        settings.validate()
        return settings

    def validate(self) -> None:
        if not self.mysql.user:
            raise ValueError("mysql.user is required")
        if not self.sync.databases:
            raise ValueError("sync.databases needs at least one database")
        for pattern in (*self.sync.tables, *self.sync.exclude_tables):
            if not pattern.strip():
                raise ValueError("table patterns may not be empty")
            if "/" in pattern:
                raise ValueError(f"table pattern {pattern!r} may not contain a slash")

    @property
    def scope(self) -> Scope:
        return Scope(tuple(self.sync.databases), tuple(self.sync.tables), tuple(self.sync.exclude_tables))


@lru_cache(maxsize=4096)
def glob_regex(pattern: str) -> str | None:
    """A regular expression for a shell pattern; None if the pattern is malformed, which matches nothing.

    ``*`` and ``?`` stop at a slash, ``[^a-z]`` negates and a backslash quotes the next
    character, unlike in the standard library's fnmatch.
    """
    out, i = [], 0
    while i < len(pattern):
        c = pattern[i]
        i += 1
        if c == "*":
            out.append("[^/]*")
        elif c == "?":
            out.append("[^/]")
        elif c == "\\":
            if i == len(pattern):
                return None
            out.append(re.escape(pattern[i]))
            i += 1
        elif c == "[":
            made = _class(pattern, i)
            if made is None:
                return None
            text, i = made
            out.append(text)
        else:
            out.append(re.escape(c))
    return "".join(out)


def _class(pattern: str, i: int) -> tuple[str, int] | None:
    negated = pattern[i : i + 1] == "^"
    i += negated
    ranges: list[tuple[str, str]] = []

    def one(i: int) -> tuple[str, int] | None:
        if i >= len(pattern) or pattern[i] in "-]":
            return None
        if pattern[i] == "\\":
            i += 1
            if i >= len(pattern):
                return None
        return (pattern[i], i + 1) if i + 1 < len(pattern) else None

    while not (ranges and pattern[i : i + 1] == "]"):
        low = one(i)
        if low is None:
            return None
        first, i = low
        last = first
        if pattern[i] == "-":
            high = one(i + 1)
            if high is None:
                return None
            last, i = high
        ranges.append((first, last))
    sound = "".join(f"{re.escape(a)}-{re.escape(b)}" for a, b in ranges if a <= b)
    if not sound:
        return ("[^/]" if negated else r"[^\s\S]"), i + 1
    return f"[{'^' if negated else ''}{sound}]", i + 1


@dataclass(frozen=True)
class Scope:
    """Which tables are mirrored: exact databases, then an optional allow list, then a deny list.

    A pattern with a dot is matched with ``database.table``, one without with the table in
    any database.
    """

    databases: tuple[str, ...]
    allow: tuple[str, ...] = ()
    deny: tuple[str, ...] = ()

    @staticmethod
    def _hit(patterns: tuple[str, ...], database: str, table: str) -> bool:
        for pattern in patterns:
            regex = glob_regex(pattern)
            if regex is not None and re.fullmatch(regex, f"{database}.{table}" if "." in pattern else table, re.S):
                return True
        return False

    def has(self, database: str, table: str) -> bool:
        if database not in self.databases:
            return False
        if self.allow and not self._hit(self.allow, database, table):
            return False
        return not self._hit(self.deny, database, table)

    def column(self, database: Column, table: Column) -> Column:
        """The same test as a column expression, so that it runs in the scan of a change log."""

        def hit(patterns: tuple[str, ...]) -> Column:
            out = F.lit(False)
            for pattern in patterns:
                regex = glob_regex(pattern)
                if regex is not None:
                    out |= (F.concat_ws(".", database, table) if "." in pattern else table).rlike(rf"(?s)\A(?:{regex})\z")
            return out

        inside = database.isin(*self.databases)
        if self.allow:
            inside &= hit(self.allow)
        return inside & ~hit(self.deny)
