import hashlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from sheafmill.llm.exact_dedup import BLOCK_ROWS, FINGERPRINT_BITS, deduplicate, duplicates, golomb_decode, golomb_encode, owned


def fold(t):
    return (t or "").encode().lower()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**48 - 1), max_size=300))
def test_golomb_round_trip(values):
    values = np.unique(np.array(values, np.uint64))
    assert (golomb_decode(golomb_encode(values)) == values).all()


def test_golomb_is_compact():
    values = np.unique(np.random.default_rng(1).integers(0, 2**48, 20000).astype(np.uint64))
    assert len(golomb_encode(values)) < 5.2 * len(values)


def test_groups(docs, corpus):
    groups = defaultdict(list)
    for i, t in corpus.items():
        groups[fold(t)].append(i)
    rows = duplicates(docs).collect()
    assert len(rows) == len(corpus) + 1
    for r in rows:
        same = groups[fold(corpus[r.doc_id])]
        assert r.keep_id == max(same) and r.kept == (r.doc_id == r.keep_id)
        assert r.group_size == len(same) + (10 in same)
        assert bytes(r.digest) == hashlib.sha256(fold(corpus[r.doc_id])).digest()


def test_deduplicate_keeps_whole_rows(docs, corpus):
    out = deduplicate(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert len({fold(r.text) for r in rows}) == len(rows) == len({fold(t) for t in corpus.values()})
    assert all(r.text == corpus[r.doc_id] for r in rows)


def test_null_ids_and_other_texts_of_an_id(spark):
    df = spark.createDataFrame([(None, "A"), (None, "a"), (1, "b"), (1, "c"), (2, "C"), (None, "z")], "doc_id long, text string")
    rows = sorted((r.doc_id or 0, r.keep_id or 0, r.group_size) for r in duplicates(df).collect())
    assert rows == [(0, 0, 1), (0, 0, 2), (0, 0, 2), (1, 1, 1), (1, 2, 2), (2, 2, 2)]
    assert sorted(r.text.lower() for r in deduplicate(df).collect()) == ["a", "b", "c", "z"]


def test_empty(empty):
    assert duplicates(empty).count() == 0 and deduplicate(empty).count() == 0


def test_codes_of_an_owner_are_compact():
    """A full sender's fingerprints, each owner's coded from the start of its range; with the heads."""
    rng = np.random.default_rng(4)
    values = np.unique(rng.integers(0, 1 << FINGERPRINT_BITS, BLOCK_ROWS, dtype=np.uint64))
    some, lows, highs, shift = owned(values, 4096, FINGERPRINT_BITS)
    codes = [golomb_encode(values[a:b], o << shift) for o, a, b in zip(some, lows, highs, strict=True)]
    assert (np.concatenate([golomb_decode(c, o << shift) for o, c in zip(some, codes, strict=True)]) == values).all()
    assert 8 * sum(map(len, codes)) / len(values) < 36
