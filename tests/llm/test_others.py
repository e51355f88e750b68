import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sheafmill.llm import chat, queries, resharding, secrets, url_filter

public_tokenizers = pytest.importorskip("public_tokenizers")


# ---- resharding ----------------------------------------------------------------


def test_flow_is_the_cheapest():
    from itertools import product

    rng = random.Random(1)
    for _ in range(60):
        supply, sinks = [rng.randint(0, 4) for _ in range(3)], 3
        capacity = [rng.randint(0, 4) for _ in range(sinks)]
        capacity[0] += max(0, sum(supply) - sum(capacity))
        home = rng.choice([[0, 1, 2], [None, 0, 1], [2, None, 0], [None] * 3, [1, 2, 0]])
        flow = resharding.min_cost_flow(supply, capacity, home)
        assert [sum(v for (i, _), v in flow.items() if i == k) for k in range(3)] == supply
        assert all(sum(v for (_, j), v in flow.items() if j == k) <= capacity[k] for k in range(sinks))
        best = None
        splits = [[s for s in product(range(n + 1), repeat=sinks) if sum(s) == n] for n in supply]
        for plan in product(*splits):
            if all(sum(row[j] for row in plan) <= capacity[j] for j in range(sinks)):
                cost = sum(plan[i][j] for i in range(3) for j in range(sinks) if home[i] != j)
                best = cost if best is None else min(best, cost)
        assert sum(v for (i, j), v in flow.items() if home[i] != j) == best


def test_flow_of_very_many_shards():
    import time

    rng = random.Random(2)
    sizes = {i: rng.randint(0, 10**9) for i in range(100_000)}
    capacities = resharding.even_capacities(sum(sizes.values()), 60_000)
    began = time.time()
    moves = resharding.plan_moves(sizes, capacities)
    assert time.time() - began < 10
    # A byte stays only where its old shard has a new one, which has room for so many.
    assert sum(e - a for i, a, e, j in moves if i == j) == sum(min(sizes[j], c) for j, c in enumerate(capacities))
    assert len(moves) <= len(sizes) + 2 * len(capacities)
    ends = {}
    for i, a, e, _ in moves:
        assert a == ends.get(i, 0) < e
        ends[i] = e
    assert {i: n for i, n in sizes.items() if n} == ends
    with pytest.raises(ValueError):
        resharding.plan_moves({0: 2}, [1])


def test_rewritten_shards_hold_every_row(spark, docs, corpus):
    found, path, changed = resharding.rewrite(docs, 7, old_shard=F.col("doc_id") % 3)
    rows = found.collect()
    assert sorted((r.row.doc_id, r.row.text or "") for r in rows) == sorted([*((i, t or "") for i, t in corpus.items()), (10, corpus[10])])
    assert rows[0].row.asDict().keys() == set(docs.columns)
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append((r.slot, len((r.row.text or "").encode()) + 16))
    assert all(sorted(s for s, _ in x) == list(range(len(x))) for x in by.values())
    assert changed >= set(by) - {0, 1, 2}


def test_only_changed_shards_are_written(spark, tmp_path):
    rows = [(i, "x" * 84) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    size = 100 * 100
    whole, path, changed = resharding.rewrite(df, 4, path=f"file://{tmp_path}/s", old_shard=(F.col("doc_id") / 100).cast("int"), capacities=[size, size // 2, size, size])
    assert changed == {1, 3}
    found = spark.read.parquet(path)
    assert {r.shard for r in found.select("shard").distinct().collect()} == {1, 3} and found.count() == 100
    by = {}
    for r in whole.collect():
        by.setdefault(r.shard, []).append((r.row.doc_id, r.slot))
    assert sorted(i for x in by.values() for i, _ in x) == list(range(300))
    assert {j: len(x) for j, x in by.items()} == {0: 100, 1: 50, 2: 100, 3: 50}
    assert all(sorted(s for _, s in x) == list(range(len(x))) for x in by.values()) and {i for i, _ in by[2]} == set(range(200, 300))
    whole, _, changed = resharding.rewrite(df, 3, old_shard=(F.col("doc_id") / 100).cast("int"))
    assert changed == set() and whole.count() == 300


def test_odd_rows_get_slots(spark):
    """Null ids, rows that repeat all of a row, and more shards than rows."""
    rows = [(None, "a"), (None, "a"), (1, None), (1, None), (2, "b"), (2, "b"), (2, "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = resharding.rewrite(df, 12, old_shard=F.lit(0))[0].select("row.*", "slot", "shard").collect()
    assert sorted((str(r.doc_id), r.text or "") for r in got) == sorted((str(i), t or "") for i, t in rows)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in by.values()) and max(by) < 12


def test_query_has_even_shards_and_gapless_slots(spark, sf_dir):
    rows = queries.op5_resharding(spark, sf_dir).collect()
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    by = {}
    for r in rows:
        assert (r.size, r.text_crc32) == (len(docs[r.doc_id].encode()) + 16, zlib.crc32(docs[r.doc_id].encode()))
        by.setdefault(r.shard, []).append((r.slot, r.size))
    assert set(by) <= set(range(40)) and all(sorted(s for s, _ in x) == list(range(len(x))) for x in by.values())
    even, largest = sum(r.size for r in rows) / 40, max(r.size for r in rows)
    loads = [sum(n for _, n in by.get(j, [])) for j in range(40)]
    # A shard is off by less than a row at each end of each range that it gets.
    assert max(loads) <= even + 2 * largest and min(loads) >= even - 2 * largest


def test_query_of_an_empty_table(spark, empty, tmp_path):
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.op5_resharding(spark, str(tmp_path)).count() == 0


def test_query_digests(spark, docs, corpus, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for r in queries.op5_resharding(spark, str(tmp_path)).collect():
        raw = (corpus[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "bytes", None) and 0 <= r.shard < 40


# ---- chat ----------------------------------------------------------------------


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a\nb\\", ""]), st.text(st.sampled_from("ab\\\n</s>[INST]|im_endstar<é"), max_size=30) | st.sampled_from(chat.CONTROL)), max_size=5))
def test_rendering_is_reversible(turns):
    text, spans = chat.render(turns)
    assert chat.parse(text) == turns
    assert [chat.unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


def test_intersection_of_spans():
    starts, ends = np.array([0, 3, 3, 7, 9]), np.array([3, 7, 7, 9, 12])
    mask, kept = chat.intersect(starts, ends, [(1, 4), (4, 4), (8, 10)])
    assert mask.tolist() == [True, True, True, True, True] and kept == [(1, 4), (8, 10)]
    assert chat.intersect(np.zeros(0, int), np.zeros(0, int), [(0, 0)])[1] == []


def test_conversations(spark):
    rows = [(1, 1, "assistant", "B [INST] \\ é"), (1, 0, "user", "a"), (1, 2, "assistant", None), (2, 0, None, "x"), (None, 0, "assistant", "</s>"), (3, 0, "assistant", ""), (1, 2, "assistant", None)]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    made = chat.format_conversations(df, public_tokenizers.path("byte_bpe_50k.json"))
    back = {r.conv_id: r for r in chat.read_back(made).collect()}
    assert [(t.role, t.text) for t in back[1].turns] == [("user", "a"), ("assistant", "B [INST] \\ é"), ("assistant", ""), ("assistant", "")]
    assert back[1].loss_text == "B [INST] \\ é" and back[None].loss_text == "</s>" and back[3].loss_text == "" and back[2].loss_text == ""
    for r in made.collect():
        assert len(r.token_ids) == len(r.loss_mask) and any(r.loss_mask) == bool(back[r.conv_id].loss_text)
    assert chat.read_back(chat.format_conversations(df.limit(0), public_tokenizers.path("byte_bpe_50k.json"))).count() == 0


# ---- secrets ---------------------------------------------------------------------


def base_spans(t):
    out = []
    for m in re.finditer(r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", t, re.A):
        if len(m[1]) >= 12:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
    return sorted(out)


def entropy_of(value):
    from collections import Counter
    from math import log2

    w = secrets.WINDOW
    return max(sum(-c / w * log2(c / w) for c in Counter(value[i : i + w]).values()) for i in range(len(value) - w + 1))


def test_spans(spark, docs, corpus):
    rng = random.Random(6)
    texts = {i + 100: "".join(rng.choice(["token", "=", ":", " ", '"', "AKIA", "ABCDEFGHIJ0123456789", "deadbeef", "0123456789abcdef", "Secret", "é", "\n", "api_key", "xY9+/", "abcdefgh1234"]) for _ in range(rng.randint(0, 40))) for i in range(150)}
    texts[300] = "hex " + "0123456789abcdef " * 700
    df = docs.select("doc_id", "text", "spans").unionByName(spark.createDataFrame([(i, t, "s") for i, t in texts.items()], "doc_id long, text string, spans string"))
    texts |= corpus
    rows = secrets.scan(df).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        assert sorted((s.start, s.kind, s.end) for s in r.base) == base_spans(texts[r.doc_id] or "")


def test_entropy_windows_and_allow_list(spark):
    key, uuid, word = "aB3dE5fG7hI9jK1lM3nO5p", "123e4567-e89b-12d3-a456-426614174000", "averylongwordwithoutanydigits"
    texts = [f"k {key} x", f"id {uuid}", word, "AAAAAAAAAAAAAAAAAAAAAAAAAA1", f"{key}EXAMPLE", f"token={key}", "zz " + key + key]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    added = {r.doc_id: [(s.start, s.end) for s in r.added] for r in secrets.scan(df).collect()}
    assert added == {0: [(2, 24)], 1: [], 2: [], 3: [], 4: [], 5: [], 6: [(3, 47)]}
    values = [key, "aaaaaaaaaaaaaaaaaaaab", "0123456789abcdefABCDEF", "ab" * 15, key + "aaaaaaaaaaaaaaaaaaaaaaaaa"]
    got = spark.createDataFrame([(v,) for v in values], "v string").select(secrets.best_entropy(F.col("v"))).collect()
    assert [round(r[0], 9) for r in got] == [round(entropy_of(v), 9) for v in values]


def test_random_keys_of_small_letters_and_digits_are_reported(spark):
    rng, letters = random.Random(9), "abcdefghijklmnopqrstuvwxyz0123456789"
    keys = [k for n in (20, 24, 32, 40) for k in ("".join(rng.choices(letters, k=n)) for _ in range(60)) if entropy_of(k) >= 3.4 and not base_spans(k) and not k.isalpha()]
    paths = ["/home/user1/data2024/corpus/part7", "usr/local/share/python3/site/", "srv/www/html2/pages/index"]
    assert len(keys) > 200
    df = spark.createDataFrame(list(enumerate(f"at {v} end" for v in keys + paths)), "doc_id long, text string")
    added = {r.doc_id: [(s.start, s.end) for s in r.added] for r in secrets.scan(df).collect()}
    assert added == {i: [(3, 3 + len(v))] if i < len(keys) else [] for i, v in enumerate(keys + paths)}


def test_long_candidates_and_many_matches_take_seconds(spark):
    import time

    rng, letters = random.Random(4), "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    blob = "".join(rng.choices(letters.replace("x", "").replace("X", ""), k=1_000_000))
    slug, path = "word" + "-abc1" * 20_000, "/abc1" * 20_000 + "/"
    many = " ".join(f"token={'ab' * 5}{i:07d} {rng.getrandbits(128):032x} x{''.join(rng.choices(letters[:62], k=24))}" for i in range(17_000))
    jwt = "token=" + ".".join("".join(rng.choices(letters[:62], k=30)) for _ in range(5))
    texts = [blob, slug, path, many, jwt, "=" * 200_000, "token=" * 50_000]
    began = time.time()
    rows = {r.doc_id: r for r in secrets.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)).collect()}
    assert time.time() - began < 90
    for i, t in enumerate(texts):
        assert sorted((s.start, s.kind, s.end) for s in rows[i].base) == base_spans(t)
    added = {i: [(s.start, s.end) for s in r.added] for i, r in rows.items()}
    assert added[0] == [(0, 1_000_000)] and added[1] == added[2] == added[4] == added[5] == added[6] == []
    assert len(rows[3].base) >= 34_000 and len(added[3]) > 15_000


def test_overlaps_match_brute_force(spark):
    rng = random.Random(8)
    rows = []
    for _ in range(200):
        cuts = sorted(rng.sample(range(60), 2 * rng.randint(0, 10)))
        a = rng.randint(0, 60)
        rows.append((cuts[::2], cuts[1::2], a, a + rng.randint(1, 15)))
    df = spark.createDataFrame(rows, "starts array<int>, ends array<int>, a int, b int")
    got = df.select("*", secrets.overlaps(F.struct(F.col("a").alias("start"), F.col("b").alias("end")), F.col("starts"), F.col("ends")).alias("met")).collect()
    for r in got:
        assert r.met == any(s < r.b and r.a < e for s, e in zip(r.starts, r.ends))


def test_mixed_letters_need_high_entropy(spark):
    texts = ["QwErTyUiOpAsDfGhJkLz xx", "ThisIsAnIdentifierOfManyWords", "aaaaaaaaaaaaaaaaaaaaaaaaaaaa", "1234567890123456789012345"]
    added = {r.doc_id: len(r.added) for r in secrets.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert added == {0: 1, 1: 0, 2: 0, 3: 0}


def test_scan_of_an_empty_table(empty):
    assert secrets.scan(empty).count() == 0


# ---- urls ------------------------------------------------------------------------


def test_rules_and_reputations(spark):
    urls = {1: "http://A.Example.com/en/7x", 2: "https://www.example.com/en/8?q=/de/", 3: "http://x.example.net/de/81", 4: "http://net/de/9#f", 5: "http://a.org/es/", 6: "nothing", 7: None, 8: "http://bad.host.io/a", 9: "http://good.host.io/a", 10: "http://new.host.io/a", 11: "http://xcom/en/", 12: "http://u@b.co.uk:80?x", 13: "a://b://c/d"}
    rows = [(i, u, "v") for i, u in urls.items()] + [(1000 + i, "http://bad.host.io/z", "v") for i in range(40)] + [(2000 + i, "http://good.host.io/z", "v") for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    outcomes = spark.createDataFrame([(1000 + i, 1) for i in range(40)] + [(2000 + i, 0) for i in range(40)] + [(8, None)], "page_id long, bad int")
    got = {r.page_id: r for r in url_filter.judge(pages, outcomes).collect()}
    assert len(got) == len(rows)
    rules = {i: got[i].rule for i in urls}
    assert rules == {1: "example.com/en/7", 2: "com/en/", 3: "example.net/de/8", 4: "net/de/", 5: "org/es/", 6: None, 7: None, 8: None, 9: None, 10: None, 11: None, 12: None, 13: None}
    assert (got[1].host, got[1].path, got[6].host, got[7].path, got[12].host, got[13].host) == ("a.example.com", "/en/7x", "", "", "u@b.co.uk:80", "b:")
    assert [got[i].verdict for i in (1, 2, 3, 4, 5, 8, 9)] == ["allow", "block", "block", "allow", "block", "block", "allow"]
    assert got[9].bad_bound < got[10].bad_bound < got[8].bad_bound


def test_posteriors_shrink(spark):
    out = spark.createDataFrame([("a.x.com", 1)] * 1 + [("b.x.com", 0)] * 50 + [("c.y.com", 1)] * 50, "host string, bad long")
    low = {r.host: r.a / (r.a + r.b) for r in url_filter.reputations(url_filter.host_counts(out))[0].collect()}
    assert low["b.x.com"] < 0.1 < low["a.x.com"] < low["c.y.com"]


def test_suffixes_are_a_parameter(spark):
    df = spark.createDataFrame([("a.b.c.example.city.jp",), ("x.co.uk",), ("com",)], "h string")
    got = df.select(url_filter.suffix_of(F.col("h"), ["city.jp", "example.city.jp"]), url_filter.domain_of(F.col("h"), ["city.jp", "example.city.jp"])).collect()
    assert [tuple(r) for r in got] == [("example.city.jp", "c.example.city.jp"), ("uk", "co.uk"), ("com", "com")]


def test_no_labels_and_no_pages(spark):
    none = spark.createDataFrame([], "page_id long, bad int")
    pages = spark.createDataFrame([(1, "http://a.b/c"), (1, "http://a.b/c")], "page_id long, url string")
    assert [r.verdict for r in url_filter.judge(pages, none).collect()] == ["allow", "allow"]
    assert url_filter.judge(pages.limit(0), none).count() == 0


# ---- pipeline ----------------------------------------------------------------------


def test_pipeline(spark, sf_dir, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert sorted(docs.columns) == sorted(columns) and 0 < docs.count() <= before
            before = docs.count()
    final = docs.collect()
    assert len(final) == before
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{tmp_path}/decontamination").collect()}
    assert all(r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in final)
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert not any(i in t for t in texts.values() for i in items)
    assert len({t.encode().lower() for t in texts.values()}) == len(texts)
