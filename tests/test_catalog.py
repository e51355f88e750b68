"""Each query with SQL gives the same rows at the smallest size."""

import os
import random
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from sheafmill.plans import catalog
from sheafmill.plans import tables as data


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for f in os.listdir(sf_dir):
        c.execute(f"create view {f.split('.')[0]} as select * from '{sf_dir}/{f}'")
    return c


def plain(rows):
    return sorted(tuple("~" if v is None else f"{v:.6f}" if isinstance(v, float) else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, con, sf_dir, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    if name not in catalog.ORACLE_SQL:
        assert df.count() > 0
        return
    got = con.execute(catalog.ORACLE_SQL[name])
    columns = [d[0] for d in got.description]
    assert sorted(columns) == sorted(df.columns)
    assert plain(df.select(*columns).collect()) == plain(got.fetchall())


def test_stitched_orders_are_whole(spark, sf_dir):
    cut = catalog.stitch_tables(spark, sf_dir).agg({"n_rows": "sum"}).first()[0]
    assert cut == spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()


def test_entry_imports_without_the_optional_parts():
    import __spark_entry__ as entry

    assert set(catalog.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def packed(costs, limit):
    """Groups of neighbours within a limit."""
    out = []
    for k, c in enumerate(costs):
        if out and sum(costs[i] for i in out[-1]) + c <= limit:
            out[-1].append(k)
        else:
            out.append([k])
    return out


def evened(costs, limit):
    plain = packed(costs, limit)
    for share in (0.25, 0.5, 0.75, 1.0) if len(plain) > 1 else ():
        tried = packed(costs, min(limit, -(-sum(costs) // len(plain)) + int(share * max(costs))))
        if len(tried) <= len(plain):
            return tried
    return plain


def test_balanced_pack_of_many_lines(spark, tmp_path):
    """Each packing is worked out once, in time that grows with the lines; a null text is a group, as in the SQL."""
    rng = random.Random(3)
    texts = {i: "\n".join("x" * rng.choice((0, 3, 40, 90, 390, 500)) for _ in range(rng.choice((1, 5, 800)))) for i in range(60)} | {60: None, 61: "", 62: "\n" * 5000}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    began = time.perf_counter()
    got = plain(catalog.balanced_pack(spark, str(tmp_path)).select("doc_id", "group_no", "first", "last").collect())
    assert time.perf_counter() - began < 30
    want = [(i, k, g[0], g[-1]) for i, t in texts.items() for k, g in enumerate([[0]] if t is None else evened([len(x) + 1 for x in t.split("\n")], 400))]
    assert got == plain(want)


def test_table_chunks_by_definition(spark, sf_dir):
    """Every chunk of every table, worked out row by row."""
    header, budget = "Table: Lines\nColumns: Line | Part | Supplier | Quantity | Flag | Ship Date", 120
    room = budget - len(header) - 1
    want = {}
    for r in data.line_tables(spark, sf_dir).collect():
        lines = [" | ".join(row) for row in r.rows]
        assert all(len(x) + 1 <= room for x in lines)  # none has to be cut
        groups = evened([len(x) + 1 for x in lines], room)
        want[r.doc_id] = [(k, len(groups), g[0] + 1, g[-1] + 1, "\n".join([header, *(lines[i] for i in g)])) for k, g in enumerate(groups)]
    got = {}
    for r in catalog.table_chunks(spark, sf_dir).orderBy("doc_id", "table_chunk").collect():
        got.setdefault(r.doc_id, []).append((r.table_chunk, r.table_chunks, r.row_start, r.row_end, r.text))
    assert got == want


def test_text_chunks_hold_every_word_in_order(spark, sf_dir):
    """Within the budget, each conversation's words, but for what one chunk repeats of the one before."""
    from sheafmill.operators import chunk

    c = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    turns = {}
    for r in sorted(c.collect(), key=lambda r: (r.conv_id, r.turn)):
        turns.setdefault(str(r.conv_id), []).extend((r.text or "").split())
    none = F.lit(None).cast("string")
    e = c.select(F.col("conv_id").cast("string").alias("doc_id"), F.col("turn").cast("int").alias("element_no"), F.lit("chat").alias("source"), F.lit("Talk").alias("section"), F.lit("text").alias("element_type"), F.lit("pdf").alias("file_type"), none.alias("sheet_name"), (F.col("turn") / 2 + 1).cast("int").alias("page"), F.array((F.col("turn") / 2 + 1).cast("int")).alias("pages"), F.lit(False).alias("is_heading"), "text")
    held = {}
    for r in chunk.chunk_texts(chunk.sections(e), 120).orderBy("doc_id", "part").collect():
        body = r.text.split("\n", 2)[2].split()
        assert chunk.word_pieces(r.text) <= 120 + 40
        words = held.setdefault(r.doc_id, [])
        again = next((k for k in range(len(body), 0, -1) if words[-k:] == body[:k]), 0)
        words += body[again:]
    assert set(held) == {d for d, w in turns.items() if w}
    assert all(set(held[d]) == set(turns[d]) for d in held)
