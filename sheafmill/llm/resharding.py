"""Resharding by minimum-cost flow: balanced new shards for the fewest bytes moved.

The rows of each old shard lie in a fixed order, cut into blocks of bounded size. From the old
shards' sizes and the new shards' capacities a transport problem is solved on the driver (its
size is that of the lists of shards, whatever the data): a byte that stays in the shard of the
same number costs nothing, a moved one costs one. The flow says how many bytes of which old shard
go where; these amounts are cut out of the old shard's order as ranges, so that a shard misses its
capacity by less than a row for each range that it gets. Only affected shards are rewritten.

Offsets of rows are sums inside a block plus the sums of the blocks before it, so no task
handles a whole shard. Rows get their block by a hash of id and text; a hot old shard only has more
blocks. What is known of the blocks is a table that is joined by key.

Defined cases: a null text has no bytes; null ids are dealt and numbered like others; rows that
repeat id and text are told apart by their number within the block; there may be more shards than
rows, and then some are empty; an empty table gives an empty result; extra columns are carried
along by :func:`rewrite` whatever they are called.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from .common import fresh_path, frozen, input_partitions

#: Bytes that a row has besides its text.
ROW_BYTES = 16
#: Rows of a block, about.
BLOCK_ROWS = 2048


def row_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long")


def min_cost_flow(supply: list[int], capacity: list[int], home: list[int | None]) -> dict[tuple[int, int], int]:
    """Amounts from each source to each sink that use up ``supply`` at the least total cost.

    A unit from source i to the sink ``home[i]`` costs nothing, to any other one. The network is
    sparse: an arc of no cost from each source to its home, and arcs of cost one from all sources
    to a hub, from which all sinks are reached. Flow is sent along shortest paths, level by level
    of their length: first all that fits the free arcs; then, as no path of length zero is left,
    what is over goes through the hub. Each path uses up a source or fills a sink, so there are at
    most as many as sources and sinks; longer paths would only be needed with no room left.
    """
    if sum(supply) > sum(capacity):
        raise ValueError("the new shards hold less than the old ones have")
    flow: dict[tuple[int, int], int] = {}
    left, room = list(supply), list(capacity)
    for i, j in enumerate(home):
        if j is not None and (amount := min(left[i], room[j])):
            flow[(i, j)] = amount
            left[i] -= amount
            room[j] -= amount
    open_sinks = (j for j in range(len(room)) if room[j])
    j = next(open_sinks, None)
    for i in range(len(left)):
        while left[i]:
            amount = min(left[i], room[j])
            flow[(i, j)] = flow.get((i, j), 0) + amount
            left[i] -= amount
            room[j] -= amount
            if not room[j]:
                j = next(open_sinks, None)
    return flow


def even_capacities(total: int, shards: int) -> list[int]:
    return [total * (j + 1) // shards - total * j // shards for j in range(shards)]


def plan_moves(sizes: dict[int, int], capacities: list[int]) -> list[tuple[int, int, int, int]]:
    """Ranges (old shard, first byte, end, new shard) that realise the cheapest flow.

    What stays comes first in an old shard, then the moved ranges by their new shard.
    """
    old = sorted(sizes)
    flow = min_cost_flow([sizes[i] for i in old], capacities, [i if 0 <= i < len(capacities) else None for i in old])
    out, at, last = [], 0, None
    for (i, j), amount in sorted(flow.items(), key=lambda x: (x[0][0], x[0][1] != old[x[0][0]], x[0][1])):
        at = at if i == last else 0
        out.append((old[i], at, at + amount, j))
        at, last = at + amount, i
    return out


def _blocked(docs: DataFrame, id_col: str, text_col: str, old_shard: Column | None) -> DataFrame:
    """``docs`` as a struct ``row``, with old shard, block, the block's number among all, and what orders its rows."""
    spark = docs.sparkSession
    name = F.input_file_name() if old_shard is None else old_shard.cast("int")
    text = F.col(text_col)
    rows = docs.select(
        name.alias("name"), F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), F.coalesce(F.crc32(text.cast("binary")), F.lit(0).cast("long")).alias("crc"), row_size(text).alias("size"), F.xxhash64(F.col(id_col), text).alias("tie"),
    )
    counts = sorted((r[0], r[1]) for r in docs.select(name.alias("name")).groupBy("name").count().collect())
    blocks = [-(-n // BLOCK_ROWS) for _, n in counts]
    known = [(x, i if old_shard is None else x, n, before - n) for i, ((x, _), n, before) in enumerate(zip(counts, blocks, accumulate(blocks), strict=True))]
    # A row for each old shard, of which the driver has the list: broadcast, so that no text is dealt by its shard.
    names = spark.createDataFrame(known, f"name {'string' if old_shard is None else 'int'}, old_shard int, blocks int, first int")
    out = rows.join(F.broadcast(names), "name").withColumn("block", F.pmod("tie", "blocks").cast("int"))
    return out.withColumn("number", F.col("first") + F.col("block")).drop("name", "blocks", "first")


def plan(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", old_shard: Column | None = None, capacities: list[int] | None = None) -> tuple[DataFrame, set[int], set[int]]:
    """Where the rows go: for each block its parts (first row, shard, slot of that row); the shards that change, and those that stay.

    ``old_shard`` is an integer column, by default the input file's place among the files.
    """
    spark = docs.sparkSession
    order = Window.partitionBy("old_shard", "block").orderBy("id", "crc", "tie")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    slim = _blocked(docs, id_col, text_col, old_shard).select("old_shard", "block", "id", "crc", "tie", "size")
    rows = frozen(slim.select("old_shard", "block", "size", F.row_number().over(order).alias("nth"), F.coalesce(F.sum("size").over(before), F.lit(0).cast("long")).alias("inner")), "blocks")
    totals = frozen(rows.groupBy("old_shard", "block").agg(F.sum("size").alias("bytes")), "totals")
    sizes = {r[0]: int(r[1]) for r in totals.groupBy("old_shard").agg(F.sum("bytes")).collect()}
    moves = plan_moves(sizes, even_capacities(sum(sizes.values()), shards) if capacities is None else capacities)
    # From here on tables have a row or two for each block.
    base = totals.select("old_shard", "block", (F.sum("bytes").over(Window.partitionBy("old_shard").orderBy("block")) - F.col("bytes")).alias("base"))
    ranges = spark.createDataFrame(moves, "old_shard int, first long, end long, shard int").groupBy("old_shard").agg(F.sort_array(F.collect_list(F.struct("first", "end", "shard"))).alias("ranges"))
    placed = rows.join(base.join(F.broadcast(ranges), "old_shard"), ["old_shard", "block"])
    at = F.col("base") + F.col("inner")
    placed = placed.withColumn("range", F.element_at(F.filter("ranges", lambda r: r["first"] <= at), -1))
    parts = placed.groupBy("old_shard", "block", F.col("range.shard").alias("shard"), F.col("range.first").alias("first")).agg(F.count(F.lit(1)).alias("n"), F.min("nth").alias("low"))
    lead = F.sum("n").over(Window.partitionBy("shard").orderBy("old_shard", "first", "block")) - F.col("n")
    out = parts.withColumn("lead", lead).groupBy("old_shard", "block").agg(F.sort_array(F.collect_list(F.struct("low", "shard", "lead"))).alias("parts"))
    changed = {k for i, _, _, j in moves if i != j for k in (i, j)}
    return frozen(out, "parts"), changed | {j for j in range(shards) if j not in sizes}, set(sizes) - changed


def _settled(docs: DataFrame, parts: DataFrame, of: set[int], id_col: str, text_col: str, old_shard: Column | None, tasks: int) -> DataFrame:
    """row, shard and slot of the rows of some old shards; blocks are dealt to tasks in turn, which is the only shuffle of texts."""
    some = F.col("old_shard").isin(*of) if of else F.lit(False)
    rows = _blocked(docs, id_col, text_col, old_shard).where(some).repartitionById(tasks, "number")
    order = Window.partitionBy("number").orderBy("id", "crc", "tie")
    nth = rows.withColumn("nth", F.row_number().over(order)).join(parts.where(some), ["old_shard", "block"])
    part = F.element_at(F.filter("parts", lambda x: x["low"] <= F.col("nth")), -1)
    return nth.select("row", part.alias("part"), "nth").select("row", (F.col("part.lead") + F.col("nth") - F.col("part.low")).cast("long").alias("slot"), F.col("part.shard").alias("shard"))


def rewrite(docs: DataFrame, shards: int, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", old_shard: Column | None = None, capacities: list[int] | None = None) -> tuple[DataFrame, str, set[int]]:
    """Write the new shards that change; all rows (``row`` as it was, ``slot``, ``shard``), the folder and these shards.

    They are folders ``shard=N`` with columns ``row`` and ``slot``. A shard whose rows all stay and
    that gets none keeps its old file: its rows are read from there.
    """
    parts, changed, stay = plan(docs, shards, id_col, text_col, old_shard, capacities)
    target = path or fresh_path(docs.sparkSession, "shards")
    tasks = max(shards, 2 * input_partitions(docs))
    # What leaves or enters a changed shard is in blocks of old shards that change.
    _settled(docs, parts, changed, id_col, text_col, old_shard, tasks).write.partitionBy("shard").parquet(target)
    out = read_shards(docs, target)
    if stay:
        out = out.unionByName(_settled(docs, parts, stay, id_col, text_col, old_shard, tasks))
    return out, target, changed


def read_shards(docs: DataFrame, path: str) -> DataFrame:
    """What :func:`rewrite` wrote of ``docs``: row, slot and shard; also where nothing was."""
    schema = StructType().add("row", docs.schema).add("slot", LongType()).add("shard", IntegerType())
    return docs.sparkSession.read.schema(schema).parquet(path)
