"""The engine: bootstrap tables, resume or take a snapshot, follow changes, serve queries."""

from __future__ import annotations

import logging

from pyspark.sql import SparkSession

from tidemark.operators.store import Catalog
from tidemark.plans.gateway import Gateway
from tidemark.plans.server import Server
from tidemark.sources.config import Settings
from tidemark.sources.snapshot import JdbcSource, TableSource, snapshot
from tidemark.streaming.changes import Applier, start_mode, stream

log = logging.getLogger("tidemark")


class Engine:
    def __init__(self, spark: SparkSession, settings: Settings, source: TableSource | None = None):
        self.spark, self.settings = spark, settings
        self.catalog = Catalog(spark, settings.duckdb.path)
        self.source = source or JdbcSource(spark, settings.mysql, settings.scope, fetch_size=settings.sync.batch_size)
        self.server: Server | None = None
        self.query = None

    def __enter__(self) -> Engine:
        return self

    def __exit__(self, *_) -> None:
        if self.query is not None and self.query.isActive:
            self.query.stop()
        if self.server is not None:
            self.server.stop()

    def position(self) -> dict | None:
        """A position that all tables have reached: that of the table furthest behind; None unless every table has one."""
        found = [self.catalog.get(t.schema, t.name) for t in self.source.tables()]
        if not found or any(m is None or m.position is None for m in found):
            return None
        return min((m.position for m in found), key=lambda p: (p.get("seq") if p.get("seq") is not None else -1, p.get("file") or "", p.get("pos") or 0))

    def run(self, changes: str | None = None, follow: bool = False) -> None:
        """Take a snapshot unless there is one, serve queries, and apply the change log: what is there, or until stopped."""
        for t in self.source.tables():
            self.catalog.create(t.schema, t.name, t.struct, t.key)
        mode = start_mode(self.position())
        log.info("start: %s", mode)
        if mode == "snapshot":
            snapshot(self.catalog, self.source, self.settings.sync.dump_concurrency)
        if self.settings.query_api.listen:
            api = self.settings.query_api
            self.server = Server(Gateway(self.spark, self.catalog, api.max_rows, api.timeout_sec), api.listen, api.token).start()
        if changes:
            known = {(t.schema, t.name): (t.struct, t.key) for t in self.source.tables()}
            applier = Applier(self.catalog, self.settings.scope, lookup=lambda d, t: known.get((d, t)))
            self.query = stream(self.spark, changes, applier, self.settings.sync.checkpoint_path, follow=follow)
            if not follow:
                self.query.awaitTermination()
