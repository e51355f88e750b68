import random
from collections import Counter

import numpy as np

from sheafmill.llm import decontaminate
from sheafmill.llm.decontaminate import BLOCK, Index, contamination, keep_clean, question_and_answer, share_in, words

from .conftest import prose


def items(rng, n):
    return [(i, prose(rng, rng.randint(12, 30)) + ". " + prose(rng, 6) + f" answer{i}.") for i in range(n)]


def everything(index, bags, threshold):
    """(passage, item, score) by adding up all postings."""
    out = []
    for k, terms in enumerate(bags):
        score = {}
        for t in terms:
            for p in range(index.start[t], index.stop[t]):
                score[int(index.item[p])] = score.get(int(index.item[p]), 0) + index.impact[p]
        out += [(k, i, round(s, 9)) for i, s in score.items() if s >= threshold - 1e-9]
    return sorted(out)


def searched(index, bags, threshold, seen=None):
    which = np.array([k for k, b in enumerate(bags) for _ in b], np.int64)
    found = index.search(which, np.array([t for b in bags for t in b], np.int64), threshold, seen)
    return sorted((k, i, round(s, 9)) for k, i, s in zip(*(x.tolist() for x in found), strict=True))


def test_block_max_wand_returns_all_above_the_threshold(monkeypatch):
    rng = random.Random(1)
    index = Index(items(rng, 4 * BLOCK))
    bags = [sorted(set(index.term_ids(words(prose(rng, rng.randint(0, 60)))).tolist()) - {-1}) for _ in range(150)]
    for passages in (1024, 7):
        monkeypatch.setattr(decontaminate, "PASSAGES", passages)
        for threshold in (0.02, 0.1, 0.3, 0.6):
            assert searched(index, bags, threshold) == everything(index, bags, threshold)


def test_blocks_are_skipped():
    """Items in groups that share no words but a few common ones: whole blocks of these have small maxima."""
    rng = random.Random(3)
    bench = []
    for i in range(20 * BLOCK):
        own = [f"g{i // BLOCK}w{rng.randint(0, 30)}" for _ in range(4 if i // BLOCK % 5 else 1)]
        bench.append((i, " ".join(own + [f"common{rng.randint(0, 9)}" for _ in range(20 if i // BLOCK % 5 else 3)])))
    index = Index(bench)
    bags = [sorted({index.vocabulary[w] for w in [f"common{k}" for k in range(10)] + rng.sample(sorted(index.vocabulary), 8)}) for _ in range(40)]
    seen = Counter()
    assert searched(index, bags, 0.55, seen) == everything(index, bags, 0.55)
    assert seen["skipped"] > 0 and seen["scored"] + seen["skipped"] < 0.8 * len(bags) * len(bench)


def test_memory_does_not_grow_with_the_items():
    import tracemalloc

    rng = random.Random(5)
    vocabulary = [f"v{k}" for k in range(30_000)]
    text = lambda n: " ".join(vocabulary[int(len(vocabulary) * rng.random() ** 3)] for _ in range(n))
    index = Index([(i, text(30)) for i in range(20_000)])
    texts = [text(600) for _ in range(decontaminate.ROWS)]
    tracemalloc.start()
    index.hits(texts, 0.5, 0.6)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400e6


def test_hits_equal_brute_force():
    """Passages, scores and shares of every text, item and passage by definition."""
    rng = random.Random(6)
    bench = items(rng, 25)
    index = Index(bench)
    texts = [prose(rng, rng.randint(0, 200)) + " " + " ".join(w for w in bench[k % 25][1].split() if rng.random() < 0.9) for k in range(40)] + ["", None]
    want = []
    for t in texts:
        tokens, best = words(t), {}
        for at in range(0, len(tokens), index.longest):
            passage = tokens[at : at + 2 * index.longest]
            terms = sorted(set(index.term_ids(passage).tolist()) - {-1})
            for _, item, score in everything(index, [terms], 0.4):
                q, a = (share_in(p, passage) for p in index.parts[item])
                if q >= 0.5 and a >= 0.5 and (item not in best or score > best[item][0]):
                    best[item] = (score, at, q, a)
        want.append([(index.ids[i], *best[i]) for i in sorted(best)])
    got = [[(h["item_id"], round(h["score"], 9), h["passage"], h["question"], h["answer"]) for h in hits] for hits in index.hits(texts, 0.4, 0.5)]
    assert got == want and sum(map(len, want)) > 10


def test_ties_and_odd_items():
    """Items without an id, of one text under two ids, very long or without words."""
    long = " ".join(f"w{k}" for k in range(5000)) + ". the end."
    bench = [(None, "alpha beta gamma delta. epsilon zeta."), (3, "alpha beta gamma delta. epsilon zeta."), (3, "alpha beta gamma delta. epsilon zeta."), (1, long), (2, "..."), (4, None)]
    index = Index(bench)
    hits = index.hits(["x alpha beta gamma delta epsilon zeta y", long, "alpha"], 0.5, 0.6)
    assert [[h["item_id"] for h in x] for x in hits] == [[3, 3, None], [1], []]
    assert Index([]).hits(["a"], 0.5, 0.6) == [[]] and Index([(1, "...")]).hits(["a", None], 0.5, 0.6) == [[], []]


def test_items_are_found_wherever_they_are(spark):
    rng = random.Random(2)
    bench = items(rng, 30)
    rows, want = [], {}
    for i in range(60):
        parts = [prose(rng, rng.randint(0, 150)), prose(rng, rng.randint(0, 150))]
        if i % 3 == 0:
            parts.insert(1, bench[i % 30][1])
            want[i] = [i % 30]
        elif i % 3 == 1:  # the question alone is no leak
            parts.insert(1, " ".join(question_and_answer(bench[i % 30][1])[0]))
        rows.append((i, " ".join(parts), "kept"))
    rows += [(None, None, "kept"), (99, "", "kept")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, hits string")
    table = spark.createDataFrame([*bench, (77, None), (78, "...")], "item_id long, text string")
    for block in (50_000, 7):
        got = {r.doc_id: [h.item_id for h in r.hits] for r in contamination(docs, table, block_items=block).collect()}
        assert len(got) == 62 and {k: v for k, v in got.items() if v} == want
        clean = keep_clean(docs, table, block_items=block)
        assert clean.columns == docs.columns
        assert sorted(r.doc_id for r in clean.where("doc_id is not null").collect()) == [k for k in sorted(got, key=lambda x: (x is None, x or 0)) if k is not None and not got[k]]


def test_the_number_of_indexes_changes_no_result(spark):
    rng = random.Random(7)
    bench = [(i, prose(rng, rng.randint(8, 60)) + ". " + prose(rng, rng.randint(3, 9)) + ".") for i in range(60)]
    rows = []
    for i in range(120):
        kept = [w for w in bench[i % 60][1].split() if rng.random() < 0.35 + 0.5 * (i / 120)]
        rows.append((i, " ".join(["zz"] * rng.randint(0, 90) + kept)))
    docs, table = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")

    def found(block):
        hits = contamination(docs, table, overlap=0.1, block_items=block).collect()
        return {r.doc_id: [(h.item_id, h.passage, round(h.score, 9)) for h in r.hits] for r in hits}

    whole = found(50_000)
    scores = [s for hits in whole.values() for _, _, s in hits]
    assert sum(s < 0.9 for s in scores) > 20
    assert found(7) == whole == found(25)


def test_without_items_or_rows(docs, empty, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert contamination(docs, none).where("size(hits) > 0").count() == 0
    assert contamination(empty, none).count() == 0 and keep_clean(empty, none).count() == 0
