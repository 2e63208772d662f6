"""python -m tidemark -config FILE [-changes FOLDER] [-follow] [-debug] [-version]"""

from __future__ import annotations

import argparse
import logging
import signal
import sys
import threading

VERSION = "0.1.0"


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tidemark")
    parser.add_argument("-config", default="configs/config.yaml")
    parser.add_argument("-changes", help="folder of change log files to follow after the snapshot")
    parser.add_argument("-follow", action="store_true", help="go on with changes that come, until stopped")
    parser.add_argument("-debug", action="store_true")
    parser.add_argument("-version", action="store_true")
    given = parser.parse_args(args)
    if given.version:
        print(VERSION)
        return 0
    logging.basicConfig(level=logging.DEBUG if given.debug else logging.INFO)
    from pyspark.sql import SparkSession

    from tidemark.engine import Engine
    from tidemark.sources.config import Settings

    try:
        settings = Settings.load(given.config)
        spark = SparkSession.builder.appName("tidemark").config("spark.scheduler.mode", "FAIR").config("spark.sql.session.timeZone", "UTC").getOrCreate()
        with Engine(spark, settings) as engine:
            stopped = threading.Event()
            for s in (signal.SIGINT, signal.SIGTERM):
                signal.signal(s, lambda *_: stopped.set())
            engine.run(given.changes, follow=given.follow)
            if settings.query_api.listen or given.follow:
                while not stopped.wait(1) and (engine.query is None or not given.follow or engine.query.isActive):
                    pass
                if engine.query is not None and engine.query.exception() is not None:
                    raise engine.query.exception()
        return 0
    except Exception:
        logging.exception("stopped")
        return 1


if __name__ == "__main__":
    sys.exit(main())
