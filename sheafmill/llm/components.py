"""Connected components of a link table by alternating large-star and small-star steps.

Each task first contracts its own links to a star for each group of nodes. Every step after that
is joins and aggregates on the links; nothing is collected but two numbers for each round. A node
with very many links is aggregated before it is shuffled, and its join is one that adaptive
execution can split. Rounds on few links run in few tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import frozen

#: Rows of a task, for tables whose size is known.
TASK_ROWS = 200_000


def in_tasks(df: DataFrame, rows: int, each: int = TASK_ROWS) -> DataFrame:
    """``df`` of about so many rows in as few tasks as that needs."""
    return df.coalesce(max(8, -(-rows // each)))


def _stars(edges: DataFrame, n: int) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = in_tasks(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), n)
    large = in_tasks(in_tasks(both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b"), n).distinct(), n)
    # Now a < b: each b links its smaller neighbours to the smallest of them.
    least = in_tasks(large.groupBy("b").agg(F.min("a").alias("m")), n)
    joined = in_tasks(large.join(least, "b"), n)
    return in_tasks(joined.where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b")).union(least.select(F.col("m").alias("a"), "b")).distinct(), n)


def _state(edges: DataFrame) -> tuple[int, int]:
    """How many links there are, and how many nodes are not yet the root or a leaf of one star."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("b", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("node").agg(F.max("up").alias("up"), F.sum("down").alias("down"))
    n, odd = nodes.agg(F.sum("down"), F.count_if(F.expr("up + down > 1"))).first()
    return n or 0, odd


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's links (a < b) to one star for each group that they join, around its smallest node."""
    root: dict = {}

    def find(x):
        while (up := root.get(x, x)) != x:
            root[x] = root.get(up, up)
            x = up
        return x

    schema = None
    for batch in batches:
        schema = batch.schema
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
        if len(root) >= TASK_ROWS:
            yield _stars_of(root, find, schema)
            root = {}
    if root:
        yield _stars_of(root, find, schema)


def _stars_of(root: dict, find, schema: pa.Schema) -> pa.RecordBatch:
    pairs = [(a, x) for x in list(root) if (a := find(x)) != x]
    return pa.record_batch([pa.array([a for a, _ in pairs], schema.field(0).type), pa.array([b for _, b in pairs], schema.field(1).type)], schema=schema)


def components(links: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(node, component) for each node of the links (a, b); a component is named by its smallest node."""
    ordered = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = frozen(ordered.coalesce(8 * max(1, links.rdd.getNumPartitions() // 64)).mapInArrow(_contract, ordered.schema).distinct(), "links")
    for _ in range(max_rounds):
        n, odd = _state(edges)
        if not odd:
            break
        edges = frozen(_stars(edges, n), "stars")
    else:
        raise RuntimeError("the components did not settle")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).union(edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
