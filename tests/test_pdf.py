"""Pages of PDF files: lines, headings, tables, margins, scans, and tables over several pages."""

from sheafmill.sources import cells, files, pdf

from .pages import Page, ruled, words


def texts(out, **having):
    return [e["text"] for e in out if e["element_type"] != "table" and all(e.get(k) == v for k, v in having.items())]


def test_a_page_in_reading_order():
    grid = [["ID", "Status", "Amount"], ["R-1", "Open", "5"], ["R-2", "Closed", "7"]]
    page = Page(
        words("Quarterly Results", 50, 100, bold=True) + words("Some prose about it here", 50, 130) + words("that goes on below", 50, 142)
        + words("Table of orders", 50, 190, bold=True) + words("After the table", 50, 300) + words("Confidential", 50, 10) + words("Page 3", 280, 780),
        tables=[ruled(50, 210, grid)],
    )
    out, section = pdf.page_elements(page, 3, None)
    assert [e["element_type"] for e in out] == ["text", "text", "table", "text", "text", "text"]
    assert texts(out, is_heading=True) == ["Quarterly Results"]
    assert texts(out, region="body")[1:] == ["Some prose about it here that goes on below", "After the table"]
    assert texts(out, region="header") == ["Confidential"] and texts(out, region="footer") == ["Page 3"]
    table = out[2]
    assert (table["heading"], table["section"], table["columns"], table["rows"]) == ("Table of orders", "Table of orders", grid[0], grid[1:])
    assert section == "Table of orders" and out[1]["section"] == "Quarterly Results" and out[3]["section"] == section
    assert all(e["page"] == 3 and e["pages"] == [3] for e in out)


def test_two_captions_on_one_line_stay_two():
    """They are headings only a wide gap apart, each over its own table."""
    page = Page(words("Left caption", 40, 100, bold=True) + words("Right caption", 360, 100, bold=True), tables=[ruled(40, 115, [["A", "B"], ["1", "2"]]), ruled(360, 115, [["C", "D"], ["3", "4"]])])
    out, _ = pdf.page_elements(page, 1, None)
    assert [(e["heading"], e["columns"]) for e in out if e["element_type"] == "table"][-1][1] == ["C", "D"]
    assert {x["text"] for x in pdf.Page(page).lines([])} == {"Left caption", "Right caption"}


def test_columns_are_read_one_after_the_other():
    lines = [w for k in range(5) for w in words(f"left line {k}", 40, 100 + 12 * k) + words(f"right line {k}", 340, 100 + 12 * k)]
    out, _ = pdf.page_elements(Page(lines), 1, None)
    assert texts(out) == [" ".join(f"left line {k}" for k in range(5)), " ".join(f"right line {k}" for k in range(5))]


def test_borderless_tables_and_side_boxes():
    rows = [("Item", "Units", "Price"), ("Bolt", "12", "0.5"), ("Nut", "40", "0.2"), ("Gear", "3", "9")]
    loose = [w for k, row in enumerate(rows) for x, cell in zip((50, 200, 350), row) for w in words(cell, x, 300 + 14 * k)]
    box = ruled(400, 100, [["Traffic", None], ["North", "10"], ["South", "20"]])
    out, _ = pdf.page_elements(Page(loose + words("Plain prose", 50, 60), tables=[box]), 1, "Open section")
    body, side = [e for e in out if e["element_type"] == "table"]
    assert (body["columns"], body["rows"], body["kind"]) == (list(rows[0]), [list(r) for r in rows[1:]], "body")
    assert (side["title"], side["kind"], side["rows"], side["has_header"]) == ("Traffic", "side", [["North", "10"], ["South", "20"]], False)
    assert texts(out) == ["Plain prose"] and out[-1] is side


def test_stamps_diagonals_and_turned_cells():
    stamp = [(c, 590, 200 + 10 * k, 10, False, False) for k, c in enumerate("DRAFT")]
    mark = [("X", 300, 400, 10, False, True, (0.7, 0.7, -0.7, 0.7, 0, 0))]
    turned = [("Up", 60, 222, 8, False, False)]
    framed, plain = ruled(560, 190, [["", ""]], width=20), ruled(50, 200, [["Name", "Value"], ["pU", "1"], ["b", "2"]])
    page = Page(words("Body text", 50, 100) + stamp + mark + turned, tables=[framed, plain])
    out, _ = pdf.page_elements(page, 1, None)
    tables = [e for e in out if e["element_type"] == "table"]
    assert len(tables) == 1 and tables[0]["rows"] == [["Up", "1"], ["b", "2"]]
    assert texts(out) == ["Body text"]


def test_tables_over_pages_are_one():
    head = ["ID", "Date", "Status"]
    first = Page(words("Records", 50, 60, bold=True), tables=[ruled(50, 700, [head, ["1", "x", "Open"], ["2", "y", "Open"]])])
    second = Page(words("Later prose of the second page that is not small", 50, 400), tables=[ruled(50, 40, [head, ["3", "z", "Closed"]]), ruled(50, 200, [["K", "V"], ["a", "b"]])])
    third = Page([], tables=[ruled(50, 300, [["", ""]])])
    out = pdf.file_elements([first, second, third])
    tables = [e for e in out if e["element_type"] == "table"]
    assert [(t["table_id"], t["n_rows"], t["merged_parts"], t["pages"]) for t in tables] == [("t001", 3, 2, [1, 2]), ("t002", 1, 1, [2])]
    assert [t["title"] for t in tables] == ["Records", "Records"] and tables[0]["headers"] == head


def test_scans_pictures_and_broken_pages():
    image = lambda x0, x1: {"x0": x0, "x1": x1, "top": 0, "bottom": 800}
    read = lambda content: f"text that was read from {content.decode()}"
    prose = lambda n: [w for k in range(n) for w in words("several words of prose on a line", 50, 100 + 12 * k)]
    pages = [Page(name="scan"), Page(prose(20), images=[image(100, 200), image(0, 10)], name="figure"), Page(prose(3), images=[image(0, 300)], name="half"), Page(prose(2), tables=["broken"], name="broken")]
    out = pdf.file_elements(pages, read)
    assert [(e["page"], e["text"].removeprefix("text that was read from ")) for e in out if e["element_type"] == "ocr_text"] == [(1, "scan"), (2, "figure at 100"), (3, "half")]
    assert [e["page"] for e in out if e["element_type"] == "text"] == [2, 3, 4]
    assert pdf.file_elements([Page()], None) == []


def test_elements_become_rows(spark, monkeypatch):
    """A PDF without its library is a row with an error; with stand-in pages it is elements."""
    rows = files.load_one("/x/a.pdf", b"", {".pdf": lambda path, content: pdf.file_elements([Page(words("Some text of a page", 50, 100))])})
    assert [(r["doc_id"], r["element_no"], r["text"]) for r in rows] == [("/x/a.pdf", 0, "Some text of a page")]
    loaded = spark.createDataFrame([("/x/a.pdf", bytearray(b"x"))], "path string, content binary")
    assert files.parse_files(loaded).first().element_type in ("error", "text")


def test_cells():
    assert [cells.one_line(x) for x in (None, " a  b ", "x \n\n y", "p\t\tq", "u v", 5)] == ["", "a b", "x y", "p q", "u v", "5"]
    assert cells.header_key("Entity / Site (x%)") == "entity site x"
    assert cells.distinct_names(["Flag", "", "flag", "FLAG"]) == ["Flag", "col_2", "flag_2", "FLAG_3"]
    assert [cells.is_label(x) for x in ("Region", "", "N/A", "1,250.5%", "x" * 41)] == [True, False, False, False, False]
