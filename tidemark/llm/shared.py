"""Where operators cut lineage: the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space as the contracts define it: space, tab, LF, VT, FF, CR.
SPACE = " \t\n\x0b\f\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder.  Where none is configured: an error on a cluster, a temporary folder on one machine (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="tidemark-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named


#: Folders written for the operators that run now: one list for each open :func:`scratch`, of the calling thread or task.
_made: ContextVar[list[str] | None] = ContextVar("tidemark_scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end, all that :func:`cut` and :func:`stage` wrote within; results have to be written before.

    Without it these files stay in the shared folder, as Spark's own checkpoints do, until
    whoever owns the folder clears it.
    """
    token = _made.set([])
    try:
        yield
    finally:
        for path in _made.get() or ():
            remove(spark, path)
        _made.reset(token)


def _note(path: str | None) -> None:
    made = _made.get()
    if made is not None and path:
        made.append(path)


#: Digits (binary) of the size that Spark expects of a frame, from which a checkpoint would hand them on to a loop's next step.
MOST_SIZE_BITS = 512


def cut(df: DataFrame) -> DataFrame:
    """Write a narrow frame to the shared folder once; later reads survive lost executors.

    A checkpoint keeps the size that Spark expected of its plan, and that of a join is the
    product of its sides.  In a loop its digits double at every join, until the driver's heap
    is full; such frames become Parquet tables, whose size is that of their files.
    """
    shared_dir(df.sparkSession)
    if plan_bytes(df).bit_length() > MOST_SIZE_BITS:
        return stage(df)
    out = df.checkpoint(eager=True)
    if _made.get() is not None:
        file = out._jdf.queryExecution().logical().rdd().getCheckpointFile()
        _note(file.get() if file.isDefined() else None)
    return out


#: Bytes of an Arrow batch between the JVM and Python workers; both sides hold a few at once.
BATCH_BYTES = "8m"


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, its session told to cut Arrow batches of texts small, unless it has a setting of its own."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(name) == "67108864b":  # Spark's default
        conf.set(name, BATCH_BYTES)
    return df


def stage(df: DataFrame) -> DataFrame:
    """Write a wide frame as a Parquet table in the shared folder and read it back.

    Columnar and compressed, so cheaper than a checkpoint where rows carry arrays or texts.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/tidemark-staged/{uuid.uuid4().hex}"
    df.write.parquet(path)
    _note(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of a few numbers each that one task takes at least.
TASK_ROWS = 50_000


def few_tasks(df: DataFrame, rows: int | None) -> DataFrame:
    """``df``, of at most ``rows`` narrow rows, in tasks of TASK_ROWS rows or more: a small step of a loop writes few files."""
    return df if rows is None else df.coalesce(rows // TASK_ROWS + 1)


def plan_bytes(df: DataFrame) -> int:
    """Bytes that Spark expects of a frame; of a staged table those of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: A key with fewer rows than this, or than one in HOT_SHARE of all, is left to the shuffle.
HOT_ROWS = 2_000
HOT_SHARE = 100_000


def split_join(rows: DataFrame, table: DataFrame, on: list[str] | str, weight: str, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``table``, which has each key once and in ``weight`` how many of ``rows`` have it.

    Keys of many rows, at most HOT_SHARE of them, are broadcast, so no key is one task.  Both
    frames are read twice and should be written ones.
    """
    on = [on] if isinstance(on, str) else on
    total, most = table.agg(F.sum(weight), F.max(weight)).first()
    limit = max(HOT_ROWS, (total or 0) // HOT_SHARE)
    if (most or 0) <= limit:
        return rows.join(table, on, how)
    hot = table.where(F.col(weight) > limit)
    often = F.broadcast(hot)
    rest = rows.join(F.broadcast(hot.select(*on)), on, "left_anti")
    return rows.join(often, on).unionByName(rest.join(table.where(F.col(weight) <= limit), on, how))


def fresh(df: DataFrame, base: str) -> str:
    """A column name like ``base`` that no column of ``df`` has (Spark compares without case)."""
    taken = {c.lower() for c in df.columns}
    name = f"__tidemark_{base}"
    while name.lower() in taken:
        name += "_"
    return name


def col(name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def small_enough(df: DataFrame, most_rows: int) -> bool:
    """Whether a frame has at most so many rows; reads no more than one row beyond that."""
    return df.limit(most_rows + 1).count() <= most_rows


#: Hashes that may be broadcast to pick rows by: 8 bytes each.
AMONG_ROWS = 5_000_000


def among(key: Column, values: DataFrame) -> Column | None:
    """Whether ``key``, a long, is one of the only column of ``values``; None if those are more than AMONG_ROWS.

    Workers get the key alone and search it in a sorted array, so rows with texts are neither
    shuffled nor converted.
    """
    values = values.distinct()
    if not small_enough(values, AMONG_ROWS):
        return None
    known = values.sparkSession.sparkContext.broadcast(np.sort(values.toArrow().column(0).to_numpy()))

    @F.arrow_udf("boolean")
    def found(keys: pa.Array) -> pa.Array:
        have, keys = known.value, keys.fill_null(0).to_numpy(zero_copy_only=False)
        if not len(have):
            return pa.array(np.zeros(len(keys), bool))
        return pa.array(have[np.minimum(np.searchsorted(have, keys), len(have) - 1)] == keys)

    return found(key)


def ranked(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with the position of each row in the global order of ``order``, from 0.

    One range sort; a partition's first position is the number of rows in those before it.
    """
    rows = cut(df.repartitionByRange(*order).sortWithinPartitions(*order)).withColumn("__at", F.monotonically_increasing_id())
    rows = rows.withColumn("__part", F.shiftright("__at", 33))
    parts = rows.groupBy("__part").agg(F.count(F.lit(1)).alias("rows")).collect()  # one row a partition
    starts, upto = [], 0
    for part, n in sorted((r[0], r[1]) for r in parts):
        starts.append((part, upto))
        upto += n
    known = df.sparkSession.createDataFrame(starts, "__part long, __start long")
    at = F.col("__at").bitwiseAND((1 << 33) - 1)
    return rows.join(F.broadcast(known), "__part").withColumn(name, F.col("__start") + at).drop("__at", "__part", "__start")
