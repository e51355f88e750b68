"""Ranking, fusion and structural look-ups over scored chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import embed, index

#: Candidates of a ranker, results, and the constant of reciprocal-rank fusion.
CANDIDATES, RESULTS, RRF = 40, 8, 60


def mask(where: Column | dict | None) -> Column:
    """A filter from a Column, or from values (or lists of them) by column; None keeps all."""
    if where is None:
        return F.lit(True)
    if isinstance(where, dict):
        out = F.lit(True)
        for name, wanted in where.items():
            out &= F.col(name).isin(*wanted) if isinstance(wanted, (list, tuple, set)) else F.col(name) == wanted
        return F.coalesce(out, F.lit(False))
    return F.coalesce(where, F.lit(False))


def ranked(scores: DataFrame, floor: float = 0.0, candidates: int = CANDIDATES) -> DataFrame:
    """The best chunks of each query above ``floor``, ties by chunk; rank from 1."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "chunk_id")
    return scores.where(F.col("score") > floor).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= candidates)


def masked(scores: DataFrame, chunks: DataFrame, where: Column | dict | None) -> DataFrame:
    """Scores of the chunks that a filter keeps; they were computed on all."""
    return scores if where is None else scores.join(chunks.where(mask(where)).select("chunk_id"), "chunk_id", "left_semi")


def fuse(rankings: list[tuple[DataFrame, float]], by: str = "need_id", k: int = RESULTS) -> DataFrame:
    """Reciprocal-rank fusion of rankings (``by``, query_id, chunk_id, rank) with weights."""
    votes = None
    for ranking, weight in rankings:
        part = ranking.select(by, "chunk_id", (F.lit(weight) / (RRF + F.col("rank"))).alias("vote"))
        votes = part if votes is None else votes.unionByName(part)
    total = votes.groupBy(by, "chunk_id").agg(F.round(F.sum("vote"), 12).alias("fused"))
    order = Window.partitionBy(by).orderBy(F.col("fused").desc(), "chunk_id")
    return total.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).select(by, "place", "chunk_id", F.round("fused", 5).alias("retrieval_score"))


def hybrid(chunks: DataFrame, needs: DataFrame, where: Column | dict | None = None, k: int = RESULTS, weights: tuple[float, float, float] = (1.0, 1.0, 1.0), text: str = "text", model: str | None = None) -> DataFrame:
    """Search by vectors, BM25 and identifiers; ``needs`` has (need_id, query_id, query), a row for each phrasing.

    Vectors are hashed ones, or those of a named ``model``.
    """
    queries = needs.select("query_id", "query")
    passages, asking = embed.embedder(model)
    dense = embed.near(chunks, queries, "chunk_id", text, passages, asking)
    scored = [(dense, -1.0), (index.bm25_search(chunks, queries, text), 0.0), (index.exact(chunks, queries, text), 0.0)]
    by_need = needs.select("query_id", "need_id")
    scored = [(s.withColumn("score", F.round("score", 9)), floor) for s, floor in scored]  # ties stay ties, however sums were ordered
    rankings = [(ranked(masked(s, chunks, where), floor).join(by_need, "query_id"), w) for (s, floor), w in zip(scored, weights, strict=True)]
    return fuse(rankings, k=k)


def by_section(chunks: DataFrame, pattern: str, where: Column | dict | None = None) -> DataFrame:
    return chunks.where(F.coalesce(F.col("section").rlike(f"(?i){pattern}"), F.lit(False)) & mask(where))


def by_table(chunks: DataFrame, table_id: str) -> DataFrame:
    return chunks.where(F.col("table_id") == table_id)


def first_pages(chunks: DataFrame, pages: int, where: Column | dict | None = None) -> DataFrame:
    """Chunks of the first pages; one without a page number is on none of them."""
    return chunks.where((F.coalesce(F.nullif("page", F.lit(0)), F.lit(99)) <= pages) & mask(where))


def neighbours(picked: DataFrame, chunks: DataFrame, window: int = 1) -> DataFrame:
    """The chunks within ``window`` places of picked ones (doc_id, chunk_index), without these themselves."""
    steps = [s for s in range(-window, window + 1) if s]
    near = picked.select("doc_id", F.explode(F.array(*[F.col("chunk_index") + s for s in steps])).alias("chunk_index")).distinct()
    return chunks.join(near, ["doc_id", "chunk_index"], "left_semi")


def context(picked: DataFrame, cap: int = 12_000, by: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Chunks in order until the first that would go over ``cap`` characters; with the text joined.

    Sizes are never negative, so the prefix within the cap is a filter on a running sum.
    """
    order = Window.partitionBy(*by).orderBy("chunk_index")
    kept = picked.dropDuplicates([*by, "chunk_index"]).withColumn("size", F.length("body")).withColumn("used", F.sum("size").over(order)).where(F.col("used") <= cap)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_index", "body"))), lambda x: x["body"]), "\n\n")
    return kept.groupBy(*by).agg(joined.alias("context"), F.sum("size").alias("chars"), F.count(F.lit(1)).alias("chunks"), F.sort_array(F.collect_list("chunk_index")).alias("picked"))
