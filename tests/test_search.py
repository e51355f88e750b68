"""Embedders, token counts, stored indexes, kept answers, and searches against plain definitions."""

import hashlib
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheafmill.functions import text as T
from sheafmill.operators import chunk, embed, index, retrieve
from sheafmill.sinks import cache, results

from .test_sources import fused_by_hand

TEXTS = ["The pump GGN-77 failed on Monday", "valve and pump were checked", "nothing to see here", "", None, "pump pump pump", "ümlaut straße pump"]


def vector(text, dimensions=384):
    words, out = re.findall("[a-z0-9]+", (text or "").lower()), [0.0] * dimensions
    for gram in words + [w[i : i + 4] for w in words for i in range(max(1, len(w) - 3))]:
        digest = hashlib.md5(gram.encode()).digest()
        out[int.from_bytes(digest[:4], "little") % dimensions] += 1.0 if digest[4] & 1 else -1.0
    norm = math.sqrt(sum(x * x for x in out)) or 1.0
    return [x / norm for x in out]


@pytest.fixture(scope="module")
def chunks(spark):
    return spark.createDataFrame([(i, t, "t1" if i % 2 else "t2") for i, t in enumerate(TEXTS)], "chunk_id int, text string, table_id string").repartition(3)


def test_hashed_vectors(spark, chunks):
    got = {r.chunk_id: r.embedding for r in embed.vectors(chunks).collect()}
    assert all(np.allclose(got[i], vector(t)) for i, t in enumerate(TEXTS))
    sparse = {}
    for r in index.hash_vectors(chunks, "chunk_id").collect():
        sparse.setdefault(r.chunk_id, {})[r.bucket] = r.weight
    assert all(np.allclose([sparse.get(i, {}).get(b, 0.0) for b in range(384)], vector(t)) for i, t in enumerate(TEXTS))


def test_prefixes_go_before_queries_and_passages():
    said = []
    make = lambda: lambda texts: said.extend(texts) or np.zeros((len(texts), 2))
    model = embed.model_of("intfloat/e5-base-v2")
    embed.with_prefix(make, model.query_prefix)()(["a"])
    embed.with_prefix(make, model.passage_prefix)()(["b"])
    embed.with_prefix(make, "")()(["c"])
    assert said == ["query: a", "passage: b", "c"] and embed.model_of("unheard") == embed.Model()
    with pytest.raises(ValueError, match="sentence-transformers"):
        embed.embedder("BAAI/bge-small-en-v1.5")[0]()(["x"])


def test_budgets_and_token_counts(spark, chunks):
    assert [chunk.default_budget(m) for m in ("x/BGE-small-en-v1.5", "all-MiniLM-L6-v2", "unheard")] == [384, 192, 192] and chunk.default_budget(override=70) == 70
    public_tokenizers = pytest.importorskip("public_tokenizers")
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = chunks.select("text", embed.token_counter(path)(F.col("text")).alias("n"), embed.token_counter()(F.col("text")).alias("estimate")).collect()
    count = embed.counting(path)
    assert all(r.n == count(r.text or "") for r in rows) and all(r.estimate == embed.counting()(r.text or "") for r in rows if r.text)


def test_a_stored_index_gives_what_a_search_without_one_gives(spark, chunks, tmp_path):
    asked = spark.createDataFrame([(1, "pump valve"), (2, "monday GGN-77 of the"), (3, "")], "query_id int, query string")
    index.build(chunks, f"{tmp_path}/index")
    lexical, vectors = index.stored(spark, f"{tmp_path}/index")
    plain = lambda df: sorted((r.query_id, r.chunk_id, round(r.score, 9)) for r in df.collect())
    assert plain(index.bm25(lexical, asked)) == plain(index.bm25_search(chunks, asked)) == plain(index.bm25(index.lexical(chunks), asked)) != []
    wanted = embed.vectors(asked.withColumnRenamed("query", "text"), "query_id").select("query_id", F.col("embedding").alias("q"))
    both = plain(index.dense_cosine(vectors, wanted))
    near = plain(embed.near(chunks, asked))
    assert len(both) == 3 * len(TEXTS) and set(near) <= set(both) and all(s == 0 for i, c, s in set(both) - set(near))
    with pytest.raises(ValueError):
        index.build(chunks.limit(0), f"{tmp_path}/none")


def test_hybrid_search_against_its_definition(spark):
    rng = np.random.default_rng(3)
    words = "pump valve noted monday ggn 77b wheel north".split()
    texts = [" ".join(rng.choice(words, 8)) for _ in range(14)]
    df = spark.createDataFrame([(i, t, "text") for i, t in enumerate(texts)], "chunk_id int, text string, element_type string")
    queries = [("pump valve noted GGN", ["ggn"]), ("observations near 77B", ["77b"])]
    needs = spark.createDataFrame([(1, i, q) for i, (q, _) in enumerate(queries)], "need_id int, query_id int, query string")
    got = sorted(r.chunk_id for r in retrieve.hybrid(df, needs, k=5).collect())
    assert got == fused_by_hand(texts, queries, range(14), 5)


def test_odd_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0]), (5, [3.0, 4.0])]
    v = spark.createDataFrame(rows, "chunk_id int, embedding array<float>")
    got = sorted((r.chunk_id, round(r.score, 6)) for r in index.dense_cosine(v, spark.createDataFrame([(9, [2.0, 0.0])], "query_id int, q array<double>")).collect())
    assert got == [(1, 1.0), (2, 0.0), (5, 0.6)]
    assert index.dense_cosine(v, spark.createDataFrame([], "query_id int, q array<double>")).count() == 0


def test_kept_answers(spark, tmp_path):
    kind, root = "key string, answer map<string,string>", f"{tmp_path}/kept"
    assert cache.get(spark, None, "answers", kind).count() == 0 and cache.get(spark, root, "answers", kind).count() == 0
    first = spark.createDataFrame([("a", {"x": "1"}), ("b", {}), ("a", {"x": "1"})], kind)
    cache.put(first, root, "answers")
    cache.put(spark.createDataFrame([("b", {"x": "other"}), ("c", {})], kind), root, "answers")
    cache.put(first, None, "answers")
    kept = {r.key: r.answer for r in cache.get(spark, root, "answers", kind).collect()}
    assert kept == {"a": {"x": "1"}, "b": {}, "c": {}}
    (tmp_path / "kept" / "broken").mkdir()
    (tmp_path / "kept" / "broken" / "part-0.parquet").write_bytes(b"not a table")
    assert cache.get(spark, root, "broken", kind).count() == 0


def test_titles_glyphs_names_and_tables(spark, chunks):
    df = spark.createDataFrame([("T", "H", "S", "(cid:127) a(cid:3)b", "/x/y.z/report.v2.pdf"), ("", "H", "S", "", "plain"), (None, None, "", None, "a.docx")], "t string, h string, s string, g string, p string")
    got = df.select(T.display_title(F.col("t"), F.col("h"), F.col("s")), T.unmapped_glyphs(F.col("g")), results.output_name(F.col("p"), ".json")).collect()
    assert [r[0] for r in got] == ["T", "H", "Untitled table"] and [r[1] for r in got] == ["• ab", "", None]
    assert [r[2] for r in got] == ["report.v2_extracted.json", "plain_extracted.json", "a_extracted.json"]
    assert {r.chunk_id for r in retrieve.by_table(chunks, "t1").collect()} == {1, 3, 5}
