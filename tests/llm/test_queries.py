"""Every query over whole small tables: against its SQL in DuckDB, or against a plain definition."""

import base64
import hashlib
import os
import zlib

import duckdb
import pytest

from sheafmill.llm import queries

from ..test_catalog import plain
from .test_minhash import brute as near_brute
from .test_suffix_dedup import brute as repeat_brute

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def odd_dir(spark, tmp_path_factory):
    """Tables with nulls everywhere, repeated rows and columns of clashing names."""
    where = tmp_path_factory.mktemp("odd")
    docs = [(1, "password = abcdefghijkl1234 x", "en", "a", 1, "c", True), (2, None, None, None, None, None, None), (3, "", "en", "", 0, "", False), (1, "password = abcdefghijkl1234 x", "en", "a", 1, "c", True), (None, "Password = ABCDEFGHIJKL1234 x", "de", "b", 2, "c", None), (9, "é" * 200 + " 0123456789abcdef" * 3, None, "z", 3, "q", None)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, spans string, kept boolean").write.parquet(f"{where}/documents.parquet")
    pages = [(1, "http://a.Example.com/en/7?x", "<p>", "v"), (2, None, None, None), (1, "http://a.Example.com/en/7?x", "<p>", "v"), (None, "x://co.uk", "", "w"), (5, "no host", "", "")]
    spark.createDataFrame(pages, "page_id long, url string, html string, verdict string").write.parquet(f"{where}/pages.parquet")
    spark.createDataFrame([(1, None, 1), (2, 1, None), (None, 0, 1), (1, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    spark.createDataFrame([(None, None), (1, "password abcdefghijkl1234 answer here now."), (1, "...")], "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    spark.createDataFrame([(1, 0, "user", None), (1, 1, None, "é [INST]"), (1, 1, "assistant", "a\\b"), (None, 0, "assistant", "</s>"), (1, 1, "assistant", "a\\b")], "conv_id long, turn long, role string, text string").write.parquet(f"{where}/conversations.parquet")
    return str(where)


def connected(folder):
    con = duckdb.connect()
    for f in os.listdir(folder):
        if f.endswith(".parquet"):
            con.execute(f"create view {f.split('.')[0]} as select * from '{folder}/{f}{'/*.parquet' if os.path.isdir(f'{folder}/{f}') else ''}'")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, sf_dir, odd_dir, name):
    for folder in (sf_dir, odd_dir) if name not in ("op8_exact_dedup", "op6_chat_format") else (sf_dir,):
        got = connected(folder).execute(queries.ORACLE_SQL[name])
        columns = [d[0] for d in got.description]
        df = queries.QUERIES[name](spark, folder)
        assert sorted(columns) == sorted(df.columns)
        assert plain(df.select(*columns).collect()) == plain(got.fetchall())


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_odd_tables(spark, odd_dir, name):
    """Nulls in any column, repeated rows, empty texts, extra columns: each row has its result."""
    rows = queries.QUERIES[name](spark, odd_dir).collect()
    assert len(rows) == {"op10_url_filter": 5, "op6_chat_format": 3}.get(name, 6)


def test_op1(spark, sf_dir):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op1_language_id(spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == set(langs) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    judged = [r.lang_pred == langs[r.doc_id] for r in rows if r.held_out and langs[r.doc_id]]
    assert sum(judged) >= 0.9 * len(judged) > 5


def test_op2(spark, sf_dir, texts):
    want = near_brute(texts, 4)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in queries.op2_minhash_dedup(spark, sf_dir).collect()} == {i: (n, c, c == i) for i, (n, c) in want.items()}


def test_op3(spark, sf_dir, texts):
    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    hexed = lambda b: hashlib.sha256(b).hexdigest()
    for r in queries.op3_bpe(spark, sf_dir).collect():
        ids = encoding.encode_ordinary(texts[r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hexed(" ".join(map(str, ids)).encode()), hexed((texts[r.doc_id] or "").encode()))


def test_op4(spark, sf_dir, texts):
    """What the query reports is what exhaustive scoring of every passage, and the overlap, give."""
    from sheafmill.llm.decontaminate import Index, share_in, words

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    index = Index(items)
    impacts = {}
    for t in range(len(index.start)):
        for p in range(index.start[t], index.stop[t]):
            impacts.setdefault(int(index.item[p]), {})[t] = index.impact[p]
    for r in queries.op4_decontamination(spark, sf_dir).collect():
        tokens, found, best = words(texts[r.doc_id]), set(), 0.0
        for at in range(0, len(tokens), index.longest):
            passage = tokens[at : at + 2 * index.longest]
            have = set(index.term_ids(passage).tolist())
            for item, own in impacts.items():
                score = sum(x for t, x in own.items() if t in have)
                if score >= 0.5 - 1e-9 and all(share_in(p, passage) >= 0.6 for p in index.parts[item]):
                    found.add(index.ids[item])
                    best = max(best, score)
        assert (r.contaminated, r.n_items, r.item_ids) == (bool(found), len(found), ",".join(map(str, sorted(found))))
        assert abs(r.best_score - best) < 1e-5


def test_op7(spark, sf_dir, texts):
    want = [(i, n, n - len(kept), len(spans), hashlib.sha256(kept).hexdigest()) for i, n, spans, kept in repeat_brute(list(texts.items()), 50)]
    rows = queries.op7_suffix_dedup(spark, sf_dir).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows) == want


def test_pipeline_of_odd_tables(spark, odd_dir, empty):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    for start in (docs, empty):
        kept = start
        for name, stage in corpus_pipeline.STAGES:
            kept = corpus_pipeline.frozen(stage(spark, kept, odd_dir), name)
            if name != "bpe":
                assert kept.columns == start.columns
        assert kept.count() <= start.count()
    assert kept.count() == 0
