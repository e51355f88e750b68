import math
import re

import pytest
from pyspark.sql import functions as F

from sheafmill.functions import text as T
from sheafmill.operators import chunk, index


def values(spark, f, inputs, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(f(F.col("v"))).collect()]


def test_dates(spark):
    given = ["2026-05-17", "17 May 2026", "06-21-2026", "21.06.2026", "03/04/26", "Aug 3", "5/5/25", "2026-02-30", "someday", None, "n/a", "May 7, 2026", "31/12/99", "13/13/2020", "2024.2-29"]
    want = [("2026-05-17", None), ("2026-05-17", None), ("2026-06-21", None), ("2026-06-21", None), (None, "date_ambiguous"), (None, "date_missing_year"), ("2025-05-05", None), (None, "date_invalid"), (None, "date_unparsed"), (None, None), (None, None), ("2026-05-07", None), ("2099-12-31", None), (None, "date_invalid"), ("2024-02-29", None)]
    assert [tuple(d) for d in values(spark, T.parse_date, given)] == want


def test_numbers(spark):
    given = ["1,131", "24.6", "+12.2%", "—", None, "-3", "1e3", "1d", "1_000", "abc", ".5", "10%", "3.0"]
    assert values(spark, T.to_number, given) == [1131, 24.6, 12.2, None, None, -3, 1000, None, None, None, 0.5, 10, 3]
    assert values(spark, T.number_is_int, given) == [True, False, False, None, None, True, True, None, None, None, False, True, False]
    assert values(spark, T.is_number, ["1,250.5%", "-.5", "x1", " 7 "]) == [True, True, False, True]


def test_cells_and_names(spark):
    assert values(spark, T.clean_cell, [None, " a  b ", "x \n\n y", "p\t\tq"]) == ["", "a b", "x y", "p q"]
    assert values(spark, T.norm_name, ["Entity / Site", "P95 (hrs)%"]) == ["entity site", "p95 hrs"]
    assert values(spark, T.text_or_null, [" N/A ", "–", "x ", None]) == [None, None, "x", None]


def test_tokens_and_cost(spark):
    assert values(spark, T.tokens, ["The R-1841-A is at 4.8%", ""]) == [["r-1841-a", "r", "1841", "a".replace("a", "a")][:3] + ["4.8", "4", "8"], []]
    texts = ["Hello, wörld 12345 _x", "", "漢字!"]
    cost = lambda t: sum(max(1, math.ceil(len(w) / 3.2)) for w in re.findall(r"[A-Za-z]+|\d+|[^\w\s]", t))
    assert values(spark, T.token_cost, texts) == list(map(cost, texts)) == list(map(chunk.word_pieces, texts))


def test_lines(spark):
    assert values(spark, T.line_signature, ["  Report Page 12 "]) == ["report page #"]
    assert values(spark, T.is_page_number, ["Page 3", "3/9", "3 of 9", "chapter 3", ""]) == [True, True, True, False, False]
    assert values(spark, T.plain_text, ["a-\nb\r\nc\td"]) == ["ab\nc d"]
    assert values(spark, T.tidy, [" a   b \n\n c "]) == ["a b\nc"]
    assert values(spark, T.unmapped_glyphs, ["(cid:127) x (cid:9)y"]) == ["• x y"]
    assert values(spark, T.without_preamble, ["Section: A\nPages: 1\nbody\nSheet: no", "(text recognised from an image)\nx", "x"]) == ["body\nSheet: no", "x", "x"]
    assert values(spark, T.sentences, ["One. Two! x;y\n\nThree"]) == [["One.", "Two!", "x;y", "Three"]]


def test_grounding(spark):
    df = spark.createDataFrame([("Ada Lovelace", "by ADA,  lovelace."), ("Bob", "none"), (None, "x"), ("", "x")], "v string, s string")
    assert [r[0] for r in df.select(T.grounded(F.col("v"), F.col("s"))).collect()] == [True, False, True, True]


def test_references(spark):
    assert values(spark, T.column_letters, [1, 26, 27, 52, 702, 703, 728, 18278], "int") == ["A", "Z", "AA", "AZ", "ZZ", "AAA", "AAZ", "ZZZ"]
    one = spark.range(1).select(T.block_range(F.lit("Raw Imports"), F.lit(1), F.lit(3), F.lit(1), F.lit(2)), T.block_range(F.lit("Ops"), F.lit(2), F.lit(9), F.lit(27), F.lit(36)), T.citation(F.lit(None).cast("string"), F.lit("Intro"), F.array(F.lit(2), F.lit(4)))).first()
    assert tuple(one) == ("'Raw Imports'!A1:B3", "Ops!AA2:AJ9", "[Intro, p.2-4]")
    assert values(spark, T.file_kind, ["a/b.PDF", "x.xlsm", "x.doc", "noext", "a.b/c"]) == ["pdf", "xlsx", "doc", None, None]


@pytest.mark.parametrize(
    ("query", "want"),
    [
        ('status of R-1841-A and "blue line"', ["blue line", "R-1841-A", "1841"]),
        ("flat 77B in GGN costs 48,219 or 4.8%", ["77B", "48,219", "4.8%", "77", "GGN"]),
        ("ALL THE words ID", []),
        ("gb GB Gb", ["GB"]),
    ],
)
def test_identifiers(spark, query, want):
    got = values(spark, index.identifiers, [query])[0]
    assert sorted(got, key=str.lower) == sorted(want, key=str.lower)
