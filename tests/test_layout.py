from pyspark.sql import functions as F

from sheafmill.operators import clean, layout, retrieve
from sheafmill.schemas import ELEMENT

NAMES = [c.split()[0] for c in ELEMENT.split(", ")]


def test_words_to_borderless_table(spark):
    words = []
    for line in range(4):
        for k, t in enumerate(("a", "b", "c")):
            words.append(("d", 1, 10.0 + 80 * k + line, 18.0 + 80 * k, 100.0 + 12 * line + (1 if k else 0), 110.0 + 12 * line, 10.0, f"{t}{line}"))
    words += [("d", 1, 10.0, 30.0, 300.0, 310.0, 10.0, "plain"), ("d", 1, 33.0, 60.0, 300.0, 310.0, 10.0, "prose")]
    df = spark.createDataFrame(words, "doc_id string, page int, x0 double, x1 double, top double, bottom double, size double, text string")
    cells = layout.words_to_lines(df)
    assert sorted(r.text for r in cells.where("line = 4").collect()) == ["plain prose"]
    t = layout.borderless_tables(cells).first()
    assert t.raw_rows == [[f"a{i}", f"b{i}", f"c{i}"] for i in range(4)]


def test_blocks_stamps_and_rows(spark):
    lines = [("d", 1, False, "body", 0, 10.0, 100.0, 10.0, 20.0, 10.0, "one"), ("d", 1, False, "body", 0, 10.0, 90.0, 24.0, 34.0, 10.0, "two"), ("d", 1, True, "body", 0, 10.0, 90.0, 36.0, 46.0, 10.0, "Head"), ("d", 1, False, "body", 0, 10.0, 90.0, 80.0, 90.0, 10.0, "far")]
    df = spark.createDataFrame(lines, "doc_id string, page int, is_heading boolean, region string, col int, x0 double, x1 double, top double, bottom double, height double, text string")
    assert [b.text for b in layout.lines_to_blocks(df).orderBy("block").collect()] == ["one two", "Head", "far"]
    chars = [("d", 1, 590.0, 598.0, 100.0 + 10 * k, 108.0 + 10 * k, False, 600.0) for k in range(5)] + [("d", 1, 300.0, 308.0, 100.0, 108.0, False, 600.0)]
    box = layout.margin_stamps(spark.createDataFrame(chars, "doc_id string, page int, x0 double, x1 double, top double, bottom double, upright boolean, page_width double")).collect()
    assert [(b.x0, b.top, b.x1, b.bottom) for b in box] == [(588.0, 98.0, 600.0, 150.0)]
    boxes = [("d", 1, 0.0, 10.0, 0.0, 10.0, "a"), ("d", 1, 60.0, 70.0, 1.0, 11.0, "b"), ("d", 1, 0.0, 10.0, 30.0, 40.0, "c"), ("d", 1, 12.0, 20.0, 30.0, 40.0, "d")]
    assert layout.recognised_rows(spark.createDataFrame(boxes, "doc_id string, page int, x0 double, x1 double, y0 double, y1 double, text string")).first().text == "a | b\nc d"


def test_wide_gaps_split_captions(spark):
    chars = [("d", 1, 1, 10.0 + 5 * k, 14.0 + 5 * k, 8.0, True) for k in range(4)] + [("d", 1, 1, 100.0 + 5 * k, 104.0 + 5 * k, 8.0, True) for k in range(4)]
    df = spark.createDataFrame(chars, "doc_id string, page int, line int, x0 double, x1 double, size double, upright boolean")
    assert [r["count"] for r in layout.split_wide(df).groupBy("segment").count().orderBy("segment").collect()] == [4, 4]


def test_heading_above_and_reading_order(spark):
    items = [("d", 1, "heading", 0, 10.0, 90.0, 10.0, 20.0, "H"), ("d", 1, "table", 0, 5.0, 95.0, 30.0, 60.0, None), ("d", 1, "text", 1, 200.0, 290.0, 5.0, 9.0, "right"), ("d", 1, "side", 0, 310.0, 350.0, 1.0, 9.0, "s"), ("d", 1, "footer", 0, 0.0, 9.0, 790.0, 799.0, "f"), ("d", 1, "table", 1, 200.0, 290.0, 300.0, 360.0, None)]
    df = spark.createDataFrame(items, "doc_id string, page int, kind string, col int, x0 double, x1 double, top double, bottom double, text string")
    assert {(r.top, r.heading) for r in layout.heading_above(df.where("kind in ('heading', 'text', 'table')")).where("kind = 'table'").collect()} == {(30.0, "H"), (300.0, None)}
    assert [r.kind for r in layout.reading_order(df).orderBy("place").collect()] == ["heading", "table", "text", "table", "side", "footer"]


def test_flags(spark):
    r = spark.range(1).select(layout.is_diagonal(F.lit(1.0), F.lit(1.0)), layout.is_diagonal(F.lit(0.0), F.lit(1.0)), layout.is_bold(F.lit("Arial-SemiBold")), layout.zone(F.lit(5.0), F.lit(12.0), F.lit(800.0), F.lit("top"), F.lit(0.0)), layout.zone(F.lit(770.0), F.lit(780.0), F.lit(800.0), F.lit("x"), F.lit(1.0)), layout.is_heading(F.lit("body"), F.lit(0.95), F.lit("Ab 1")), layout.is_heading(F.lit("body"), F.lit(0.95), F.lit("Abc"))).first()
    assert list(r) == [True, False, True, "header", "footer", False, True]


def test_cleaning(spark):
    rows = []
    for p in range(1, 6):
        rows.append({"doc_id": "d", "element_no": p, "element_type": "text", "file_type": "pdf", "page": p, "region": "body", "text": f"ACME  Report {p}\nbody ﬁne of page-\nbreak {'x' * p}\n\n\n\nPage {p} of 5"})
    rows.append({"doc_id": "d", "element_no": 9, "element_type": "text", "page": 5, "region": "footer", "text": "gone"})
    rows.append({"doc_id": "s", "element_no": 1, "element_type": "text", "file_type": "xlsx", "page": 1, "region": "body", "text": "12\n13"})
    rows.append({"doc_id": "d", "element_no": 10, "element_type": "table", "page": 5, "rows": [["12"]], "text": None})
    rows.append({"doc_id": "d", "element_no": 11, "element_type": "text", "page": 5, "region": "body", "text": " 7 "})
    df = spark.createDataFrame([tuple(r.get(n) for n in NAMES) for r in rows], ELEMENT)
    out = {(r.doc_id, r.element_no): r.text for r in clean.clean_elements(df).collect()}
    assert out == {**{("d", p): f"body fine of pagebreak {'x' * p}" for p in range(1, 6)}, ("s", 1): "12\n13", ("d", 10): None}


def test_masks_and_neighbours(spark):
    chunks = spark.createDataFrame([("d", i, f"c{i}", "Log" if i % 2 else None, i) for i in range(6)], "doc_id string, chunk_index int, chunk_id string, section string, page int")
    assert [r.chunk_index for r in retrieve.neighbours(chunks.where("chunk_index in (0, 3)"), chunks, 1).orderBy("chunk_index").collect()] == [1, 2, 4]
    assert retrieve.by_section(chunks, "log", {"page": [1, 3]}).count() == 2
    assert [r.page for r in retrieve.first_pages(chunks, 2).orderBy("page").collect()] == [1, 2]
