import numpy as np

from sheafmill.llm.components import components
from sheafmill.llm.minhash import deduplicate, least_matches, near_duplicates, shingle_hashes, shingle_set, signatures, word_hashes


def brute(texts, width, threshold=80):
    sets = {i: shingle_set(t or "", width) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= threshold * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def check(docs, texts, width):
    want = brute(texts, width)
    rows = near_duplicates(docs, width=width).collect()
    for r in rows:
        assert (r.n_shingles, r.component_id) == want[r.doc_id]
        assert r.kept == (r.doc_id == r.component_id)
    return rows


def test_components_match_brute_force(docs, corpus):
    for width in (4, 5):
        assert len(check(docs, corpus, width)) == len(corpus) + 1


def test_dense_group_of_many_near_copies(spark):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(200)]
    texts = {}
    for i in range(700):
        words = list(base)
        for k in rng.integers(0, 200, int(rng.integers(0, 9))):
            words[k] = f"x{rng.integers(0, 10**6)}"
        texts[i] = " ".join(words)
    check(spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4), texts, 4)


def test_deduplicate(docs, corpus):
    out = deduplicate(docs)
    want = brute(corpus, 5)
    assert out.columns == docs.columns
    assert {r.doc_id for r in out.collect()} == {c for _, c in want.values()}


def test_null_ids_are_linked_with_nothing(spark):
    text = " ".join(map(str, range(50)))
    df = spark.createDataFrame([(None, text), (None, text), (4, text), (2, text)], "doc_id long, text string")
    rows = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in near_duplicates(df).collect())
    assert rows == [(0, 0, True), (0, 0, True), (2, 2, True), (4, 2, False)]


def test_pruning_misses_no_more_than_it_may():
    floors = least_matches(0.8)
    rng = np.random.default_rng(1)
    matches = np.cumsum(rng.random((20000, 200)) < 0.8, axis=1)[:, 19::20]
    assert (matches < floors).any(axis=1).mean() < 1e-3
    assert floors[-1] > 110


def test_signatures_estimate_similarity():
    words = [f"t{i}" for i in range(2000)]
    a = shingle_hashes(np.frombuffer(" ".join(words).encode(), np.uint8), 5)
    b = shingle_hashes(np.frombuffer(" ".join(words[:1800]).encode(), np.uint8), 5)
    s = signatures([a, b])
    assert abs((s[0] == s[1]).mean() - 0.9) < 0.08


def test_long_words_and_texts():
    raw = ("x" * 600_000 + " a b c d " + "y" * 300_000).encode()
    assert len(shingle_hashes(np.frombuffer(raw, np.uint8), 5)) == len(shingle_set(raw.decode(), 5)) == 2


def test_chains_are_one_component(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 101), (102, 101)] + [(200, 200)]
    rows = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {rows[i] for i in range(61)} == {0} and {rows[100], rows[101], rows[102]} == {100} and 200 not in rows


def test_empty(empty):
    assert near_duplicates(empty).count() == 0 and deduplicate(empty).count() == 0


def test_words_with_colliding_sums_of_powers_differ():
    """Two Thue-Morse words: their polynomial hashes modulo 2^64 are equal for any base."""
    bits = "a"
    while len(bits) < 2048:
        bits += bits.translate(str.maketrans("ab", "ba"))
    other = bits.translate(str.maketrans("ab", "ba"))
    a, b = (np.frombuffer(x.encode(), np.uint8) for x in (bits, other))
    assert word_hashes(a)[0] != word_hashes(b)[0]


def test_a_word_of_any_length_has_one_hash():
    for size in (63, 64, 65, (1 << 18) - 1, 1 << 18, (1 << 18) + 1, 1 << 19):
        word = b"y" * size
        hashes = {int(word_hashes(np.frombuffer(before + word + after, np.uint8))[-1 if before else 0]) for before in (b"", b"one ", b"x " * 140_000) for after in (b"", b"\n", b" ")}
        assert len(hashes) == 1


def test_texts_of_one_shingle_set_are_linked(spark):
    """Different texts with the same set, and a text whose words repeat."""
    base = " ".join(f"w{i % 40}" for i in range(80))
    texts = {1: base, 2: base + " " + base, 3: base.upper(), 4: " ".join(f"w{(i + 3) % 40}" for i in range(90)), 5: None, 6: "one two", 7: "one  two\n"}
    check(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), texts, 4)


def test_buckets_of_several_blocks(spark, monkeypatch):
    """A mixed bucket over many blocks, by rows and by bytes, and components that only block pairs join."""
    from sheafmill.llm import minhash

    monkeypatch.setattr(minhash, "MARKS_BLOCK", 16)
    monkeypatch.setattr(minhash, "TEXTS_BLOCK", 8)
    monkeypatch.setattr(minhash, "BYTES_BLOCK", 4000)
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(120)]
    texts = {}
    for i in range(160):
        words = list(base)
        for k in rng.integers(0, 120, int(rng.integers(0, 7))):
            words[k] = f"x{rng.integers(0, 10**6)}"
        texts[i] = " ".join(words)
    check(spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3), texts, 4)
