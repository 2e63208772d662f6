"""Progress of a snapshot: how far each table's job is, logged at most every two seconds."""

from __future__ import annotations

import logging
import threading
import time

from pyspark.sql import SparkSession

log = logging.getLogger("tidemark")

EVERY_S = 2.0


def percent(done: int, total: int, ended: bool = False) -> float:
    """A share that only an ended job shows as whole."""
    if ended:
        return 100.0
    return 0.0 if total <= 0 else min(99.9, round(100 * done / total, 1))


class Watch:
    """Logs the tasks done of the jobs that the calling thread starts within ``with``."""

    def __init__(self, spark: SparkSession, name: str, rows: int, every_s: float = EVERY_S):
        self.context, self.name, self.rows, self.every_s = spark.sparkContext, name, rows, every_s
        self.group, self.ended = f"snapshot {name}", threading.Event()
        self.thread = threading.Thread(target=self._run, daemon=True)

    def __enter__(self) -> Watch:
        self.began = time.time()
        self.context.setJobGroup(self.group, self.group)
        self.thread.start()
        return self

    def __exit__(self, kind, *_) -> None:
        self.ended.set()
        self.context.setLocalProperty("spark.jobGroup.id", None)
        if kind is None:
            s = max(time.time() - self.began, 1e-3)
            log.info("%s: done, about %d rows in %.1f s, %.0f rows/s", self.name, self.rows, s, self.rows / s)

    def shares(self) -> tuple[int, int]:
        """Tasks done and tasks known of the group's jobs."""
        tracker, done, total = self.context.statusTracker(), 0, 0
        for job in tracker.getJobIdsForGroup(self.group):
            info = tracker.getJobInfo(job)
            for stage in info.stageIds if info else ():
                found = tracker.getStageInfo(stage)
                if found:
                    done, total = done + found.numCompletedTasks, total + found.numTasks
        return done, total

    def _run(self) -> None:
        while not self.ended.wait(self.every_s):
            done, total = self.shares()
            log.info("%s: %.1f %% (%d of %d tasks), %.0f rows/s", self.name, percent(done, total), done, total, self.rows * done / max(total, 1) / max(time.time() - self.began, 1e-3))
