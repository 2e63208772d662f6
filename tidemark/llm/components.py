"""Connected components of an edge list, with joins and aggregations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import cut


def components(edges: DataFrame) -> DataFrame:
    """Rows (id, root) for every end of ``edges`` (a, b); ids of one component share the root.

    Each round maps every node to the neighbour (or itself) that comes first in a hashed
    order and contracts the edges along that map.  A star takes two or three rounds, a chain
    a logarithmic number; the maps are composed at the end.  Self loops give no row.
    """
    rank = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("v"))
    left = cut(edges.select("a", "b").where(F.col("a") != F.col("b")).distinct())
    maps: list[DataFrame] = []
    while not left.isEmpty():
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = cut(both.groupBy("a").agg(F.min(rank("b")).alias("m")).select(F.col("a").alias("id"), F.least(rank("a"), F.col("m"))["v"].alias("up")))
        maps.append(up)
        left = left.join(up, F.col("a") == F.col("id")).select(F.col("up").alias("a"), "b")
        left = left.join(up, F.col("b") == F.col("id")).select("a", F.col("up").alias("b"))
        left = cut(left.where(F.col("a") != F.col("b")).distinct())
    if not maps:
        return left.select(F.col("a").alias("id"), F.col("b").alias("root"))
    found = maps.pop().select("id", F.col("up").alias("root"))
    while maps:
        found = maps.pop().join(found.select(F.col("id").alias("up"), "root"), "up", "left").select("id", F.coalesce("root", "up").alias("root"))
    return cut(found)
