"""Connected components of an edge table, by alternating large and small stars.

Every step is a grouped minimum (combined on the map side) and a join of two
written tables, so a hub's edges can be split over tasks. Nothing but the
verdict "all stars" reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import stored

#: Edges for each task and file while stars are formed.
TASK_ROWS = 1 << 16


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns ``a``, ``b``, any order); root is the smallest node reachable.

    Loops and repeated edges change nothing. Nodes without an edge are not listed, but
    every root is, with itself.
    """
    e = stored(edges.filter("a <> b").selectExpr("greatest(a, b) AS u", "least(a, b) AS v").distinct(), "edges")
    # Edges don't become more, but for one of each node. Tasks and files follow their number, not the session's number of partitions.
    tasks = max(1, -(-e.count() // TASK_ROWS))
    while not _all_stars(e):
        both = e.union(e.selectExpr("v AS u", "u AS v"))
        smallest = stored(_smallest(both).coalesce(tasks), "smallest")
        e = stored(_hung(both.filter("v > u"), smallest).distinct().coalesce(tasks), "edges")
        # The upper end of every edge comes first now, so the smallest of each is one of its own edges.
        smallest = stored(_smallest(e).coalesce(tasks), "smallest")
        e = stored(_hung(e, smallest).union(smallest.selectExpr("u", "m AS v")).distinct().coalesce(tasks), "edges")
    return e.selectExpr("u AS node", "v AS root").union(e.selectExpr("v AS node", "v AS root").distinct())


def _smallest(neighbours: DataFrame) -> DataFrame:
    """``u, m``: the smallest neighbour of ``u``, or ``u`` itself if that is smaller."""
    return neighbours.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def _hung(moved: DataFrame, smallest: DataFrame) -> DataFrame:
    """The far end of every edge of ``moved``, hung on the smallest of ``u``."""
    return moved.join(smallest, "u").selectExpr("v AS u", "m AS v").filter("u <> v")


def _all_stars(e: DataFrame) -> bool:
    """If every upper node has one edge and no lower node has an upper role."""
    roles = e.selectExpr("u AS node", "1 AS up", "0 AS low").union(e.selectExpr("v AS node", "0 AS up", "1 AS low"))
    return roles.groupBy("node").agg(F.sum("up").alias("up"), F.max("low").alias("low")).filter(
        "up > 1 OR (up > 0 AND low > 0)").isEmpty()
