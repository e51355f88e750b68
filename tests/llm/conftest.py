import random

import pytest

WORDS = "the of and river stone light harbor quiet ember window letter orchard marble lantern copper meadow winter signal garden thunder".split()
DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, component_id string, spans string"


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + (rng.choice(".,;") if rng.random() < 0.1 else "") for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Texts by id: exact copies (some in other case), near copies, shared passages, nulls, blanks, a long one."""
    rng = random.Random(5)
    texts = {i: prose(rng, rng.randint(5, 120)) for i in range(0, 40)}
    texts[40] = texts[3]
    texts[41] = texts[3].upper()
    texts[42] = texts[7]
    long = prose(rng, 400)
    for k in range(43, 60):
        words = long.split()
        for _ in range(rng.randint(0, 12)):
            words[rng.randrange(len(words))] = rng.choice(WORDS) + str(rng.randint(0, 99))
        texts[k] = " ".join(words)
    passage = prose(rng, 60)
    for k in (61, 62, 63):
        texts[k] = prose(rng, 30) + "\n" + passage + "\n" + prose(rng, 30)
    texts |= {64: None, 65: "", 66: "  \t\n ", 67: "one two", 68: "ONE two", 69: "12345 678", 70: prose(rng, 9000), 71: "é" * 300, 72: "😀 ñandú über straße\x00 x"}
    return texts


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """Columns clash with names that operators give their results."""
    rows = [(i, t, "en", "s", None if t is None else len(t), True, "c", "x") for i, t in corpus.items()]
    rows.append(rows[10])
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
