"""Lexical, dense and exact-identifier indexes over chunks, as tables.

Statistics (document frequency, lengths, number of chunks, hits) are always of the whole corpus;
a mask is applied when ranking, so it never changes a score. Chunks are named by ``chunk_id``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions.text import tokens
from ..storage import settled
from . import embed

K1, B = 1.5, 0.75
DIMENSIONS = embed.DIMENSIONS


@dataclass(frozen=True)
class Lexical:
    """``postings`` (term, chunk_id, tf, length), ``terms`` (term, df), ``corpus`` (n, avg_length), one row."""

    postings: DataFrame
    terms: DataFrame
    corpus: DataFrame


def lexical(chunks: DataFrame, text: str = "text") -> Lexical:
    """Counts are aggregated before the shuffle; a chunk without terms still counts for the mean length."""
    bags = chunks.select("chunk_id", tokens(F.col(text)).alias("terms")).withColumn("length", F.coalesce(F.size("terms"), F.lit(0)).cast("bigint"))
    postings = bags.select("chunk_id", "length", F.explode("terms").alias("term")).groupBy("term", "chunk_id", "length").agg(F.count(F.lit(1)).alias("tf"))
    terms = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    corpus = bags.agg(F.count(F.lit(1)).alias("n"), F.avg("length").alias("avg_length"))
    return Lexical(postings, terms, corpus)


def idf(n: Column, df: Column) -> Column:
    return F.log(1 + (n - df + 0.5) / (df + 0.5))


def asked_terms(queries: DataFrame) -> list[str]:
    """The distinct terms of a stated set of queries: a literal list, which filters rows where they are read."""
    return sorted(r.term for r in queries.select(F.explode(tokens(F.col("query"))).alias("term")).distinct().collect())


def bm25(index: Lexical, queries: DataFrame) -> DataFrame:
    """(query_id, chunk_id, score) for ``queries`` (query_id, query); a query's repeated terms count once."""
    terms = asked_terms(queries)
    asked = queries.select("query_id", F.explode(F.array_distinct(tokens(F.col("query")))).alias("term"))
    n, mean = index.corpus.select("n").scalar(), F.coalesce(F.nullif(index.corpus.select("avg_length").scalar(), F.lit(0.0)), F.lit(1.0))
    # Only the asked terms' postings take part.
    matched = index.postings.where(F.col("term").isin(terms)).join(asked, "term")
    frequencies = index.terms.where(F.col("term").isin(terms))
    weight = idf(n, F.col("df")) * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / mean))
    return matched.join(frequencies, "term").groupBy("query_id", "chunk_id").agg(F.sum(weight).alias("score"))


def matches(chunks: DataFrame, queries: DataFrame, text: str = "text") -> DataFrame:
    """(chunk_id, length, term, tf) of the asked terms, and a row of the empty term for each chunk, written down.

    The chunks' terms are found once and the asked ones kept where they lie; of the others only
    their number is, so what is shuffled are hits.
    """
    terms = asked_terms(queries)
    bags = chunks.select("chunk_id", F.coalesce(tokens(F.col(text)), F.array().cast("array<string>")).alias("terms"))
    kept = F.filter("terms", lambda t: t.isin(terms)) if terms else F.array().cast("array<string>")
    every = bags.select("chunk_id", F.size("terms").cast("bigint").alias("length"), F.explode(F.concat(F.array(F.lit("")), kept)).alias("term"))
    return settled(every.groupBy("chunk_id", "length", "term").agg(F.count(F.lit(1)).alias("tf")), "matches")


def bm25_search(chunks: DataFrame, queries: DataFrame, text: str = "text") -> DataFrame:
    """:func:`bm25` of queries over chunks that have no index: (query_id, chunk_id, score)."""
    found = matches(chunks, queries, text)
    rows = found.where("term = ''")
    hits = found.where("term <> ''")
    corpus = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("length").alias("avg_length"))
    return bm25(Lexical(hits, hits.groupBy("term").agg(F.count(F.lit(1)).alias("df")), corpus), queries)


def build(chunks: DataFrame, path: str, text: str = "text", make: Callable[[], embed.Encoder] = embed.hashed) -> None:
    """Write what a search needs of ``chunks`` under ``path``: postings by term, document frequencies, sizes and vectors."""
    if chunks.isEmpty():
        raise ValueError("there are no chunks to index")
    made = lexical(chunks, text)
    made.postings.repartition("term").sortWithinPartitions("term").write.parquet(f"{path}/postings")
    stored = chunks.sparkSession.read.parquet(f"{path}/postings")
    stored.groupBy("term").agg(F.count(F.lit(1)).alias("df")).write.parquet(f"{path}/terms")
    made.corpus.write.parquet(f"{path}/corpus")
    embed.vectors(chunks, "chunk_id", text, make).write.parquet(f"{path}/vectors")


def stored(spark: SparkSession, path: str) -> tuple[Lexical, DataFrame]:
    """The lexical index and the vectors that :func:`build` wrote; a filter on terms reaches the files."""
    read = lambda name: spark.read.parquet(f"{path}/{name}")
    return Lexical(read("postings"), read("terms"), read("corpus")), read("vectors")


def hash_vectors(texts: DataFrame, key: str, text: str = "text", dimensions: int = DIMENSIONS) -> DataFrame:
    """Sparse unit vectors (key, bucket, weight); a text whose buckets cancel out has none."""
    return embed.sparse_vectors(texts, key, text, lambda: embed.hashed(dimensions))


def sparse_cosine(vectors: DataFrame, queries: DataFrame) -> DataFrame:
    """(query_id, chunk_id, score) of sparse unit vectors by chunk_id and by query_id, joined on the bucket."""
    return vectors.join(queries.withColumnRenamed("weight", "q"), "bucket").groupBy("query_id", "chunk_id").agg(F.sum(F.col("weight") * F.col("q")).alias("score"))


def dense_cosine(vectors: DataFrame, queries: DataFrame) -> DataFrame:
    """(query_id, chunk_id, score): a stated set of query vectors (query_id, q) against all rows.

    The queries are one matrix, which every Arrow batch of rows is multiplied with; lengths are
    worked out once for each row. A vector without length scores zero, and one that is null or of
    another size than the queries gets no row.
    """
    asked = [(r.query_id, r.q) for r in queries.select("query_id", "q").collect() if r.q]
    if len({len(q) for _, q in asked}) > 1:
        raise ValueError("the query vectors differ in size")
    wanted = _unit(np.array([q for _, q in asked], float)) if asked else np.zeros((0, 0))
    ids = pa.array([i for i, _ in asked], to_arrow_type(queries.schema["query_id"].dataType))
    field = vectors.schema["chunk_id"]
    kind = StructType([queries.schema["query_id"], field, StructField("score", DoubleType())])
    arrow = pa.schema([("query_id", ids.type), ("chunk_id", to_arrow_type(field.dataType)), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fits = pc.fill_null(pc.equal(pc.list_value_length(batch.column(1)), wanted.shape[1]), False)
            batch = batch.filter(fits)
            if len(wanted) and batch.num_rows:
                rows = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, -1)
                scores = _unit(rows) @ wanted.T
                yield pa.record_batch([ids.take(pa.array(np.tile(np.arange(len(ids)), len(rows)))), batch.column(0).take(pa.array(np.repeat(np.arange(len(rows)), len(ids)))).cast(arrow.field(1).type), pa.array(scores.ravel())], schema=arrow)

    return vectors.select("chunk_id", "embedding").mapInArrow(run, kind)


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return np.divide(rows, length, out=np.zeros_like(rows), where=length > 0)


# What an identifier looks like, in order, and capital words that are none.
IDENTIFIERS = (r"\b[A-Za-z]{1,8}-\d[\w-]*\b", r"\b\d+[A-Za-z]\b", r"(?<![\w.])\d[\d,]*(?:\.\d+)?%?", r"\b[A-Z]{2,8}\b")
IGNORED_CAPS = ("AND", "THE", "FOR", "ALL", "NOT", "ANY", "ID", "OR", "IS", "OF", "TO", "IN")


def identifiers(query: Column) -> Column:
    """Quoted strings, then identifiers by kind, each once whatever its case."""
    quoted = F.filter(F.transform(F.regexp_extract_all(query, F.lit(r"\"[^\"]{2,60}\"|'[^']{2,60}'"), F.lit(0)), lambda q: F.substr(q, F.lit(2), F.length(q) - 2)), lambda q: q != "")
    kinds = [F.transform(F.regexp_extract_all(query, F.lit(p), F.lit(0)), lambda t: F.regexp_replace(t, "^[ ,.]+|[ ,.]+$", "")) for p in IDENTIFIERS]
    plain = F.filter(F.concat(*kinds), lambda t: (F.length(t) >= 2) & ~F.upper(t).isin(*IGNORED_CAPS))
    both = F.concat(quoted, plain)
    lowered = F.transform(both, lambda t: F.lower(t))
    return F.filter(both, lambda t, i: F.array_position(lowered, F.lower(t)) == i + 1)


def has_identifier(text: Column, token: Column) -> Column:
    """Whether a lower-cased token stands in a text, not within a longer word or number."""
    quoted = F.regexp_replace(token, r"([\\.\[\]{}()*+?^$|\-])", r"\\$1")
    low = F.lower(text)
    return low.contains(token) & F.regexp_like(low, F.concat(F.lit("(?<![a-z0-9])"), quoted, F.lit("(?![a-z0-9])")))


def exact(chunks: DataFrame, queries: DataFrame, text: str = "text") -> DataFrame:
    """(query_id, chunk_id, score): a rarer identifier weighs more. The hits count all chunks."""
    asked = queries.select("query_id", F.explode(F.transform(identifiers(F.col("query")), lambda t: F.lower(t))).alias("token"))
    n = chunks.agg(F.count(F.lit(1)).alias("n")).scalar()
    all_tokens = asked.agg(F.collect_set("token").alias("ts")).scalar()
    hits = chunks.select("chunk_id", F.col(text).alias("text"), all_tokens.alias("ts")).select("chunk_id", F.explode(F.filter("ts", lambda t: has_identifier(F.col("text"), t))).alias("token"))
    weights = hits.groupBy("token").agg(F.log(1 + n / (1 + F.count(F.lit(1)))).alias("weight"))
    return hits.join(weights, "token").join(asked, "token").groupBy("query_id", "chunk_id").agg(F.sum("weight").alias("score"))
