import pytest
from pyspark.sql import functions as F

from sheafmill.operators import chunk, extract
from sheafmill.operators import tables as tab
from sheafmill.schemas import ELEMENT

NAMES = [c.split()[0] for c in ELEMENT.split(", ")]


def elements(spark, rows):
    base = {"element_type": "table", "file_type": "pdf", "has_header": True, "secondary_sheet": False, "pages": [1], "page": 1, "title": "T", "merged_parts": 1}
    out = []
    for i, r in enumerate(rows):
        r = base | {"doc_id": "d", "element_no": i, "table_id": f"t{i:03d}"} | r
        if r.get("columns"):
            r.setdefault("headers", r["columns"])
            r.setdefault("n_rows", len(r["rows"]))
        out.append(tuple(r.get(n) for n in NAMES))
    return spark.createDataFrame(out, ELEMENT)


def test_wide_record(spark):
    t = tab.classify(elements(spark, [{"columns": ["ID", "Name", "Department", "Location", "Date", "Status", "Amount", "Quantity", "Unit Price", "Discount"], "rows": [["REC-1", "Ari", "Finance", "Pune", "2026-10-08", "Closed", "1250.75", "3", "500", "10%"]]}]))
    r = tab.master_records(t).first()
    assert (r.record_id, r.location, r.amount, r.quantity, r.unit_price, r.discount) == ("REC-1", "Pune", 1250.75, 3, 500, 10)
    assert r.quantity_is_int and not r.amount_is_int and r.source_fields == {} and r.flags == ["missing_owner"]
    assert tab.ancillary_tables(t).count() == 0


def test_residual_column_and_secondary_sheet(spark):
    columns = ["ID", "Name", "Date", "Status", "Department", "Location", "Amount", "Priority", "Legacy Payload"]
    row = ["R", "n", "2026-01-01", "Open", "d", "l", "1", "High", "VAL-6662"]
    t = tab.classify(elements(spark, [{"columns": columns, "rows": [row], "file_type": "xlsx", "title": "Main"}, {"columns": ["ID", "Date", "Status", "Department", "Amount"], "rows": [["1", "2", "3", "4", "5"]], "file_type": "xlsx", "secondary_sheet": True, "sheet_name": "Transactions", "block_range": "Transactions!A1:E2"}]))
    assert [r["class"] for r in t.orderBy("element_no").collect()] == ["master", "secondary"]
    rest = {r.table_id: r for r in tab.ancillary_tables(t).collect()}
    assert rest["t000"].table_name == "Main - additional columns" and rest["t000"].headers == ["Legacy Payload"] and rest["t000"].rows == [["VAL-6662"]]
    assert rest["t001"].sheet_name == "Transactions" and rest["t001"].block_range == "Transactions!A1:E2"
    assert tab.generic_tables(t).first().rows == [{"ID": "1", "Date": "2", "Status": "3", "Department": "4", "Amount": "5"}]


def test_legacy_pairs(spark):
    said = "ID=REC-00001; Name=Ari Sharma; Department=Finance; Location=Mumbai; Date=2026-10-08; Status=Closed; Amount=1,250.50; Priority=High; Custom Tag=legacy; a=b=c; =x; none"
    df = spark.createDataFrame([(said, *[None] * 8, None)], "source string, record_id string, name string, department string, location string, date_raw string, status string, priority string, entity_site string, amount double")
    r = extract.promote(df.withColumn("source_fields", extract.pairs_of(F.col("source")))).first()
    assert (r.record_id, r.name, r.amount, r.entity_site) == ("REC-00001", "Ari Sharma", 1250.5, "Mumbai")
    assert [(p.key, p.value) for p in r.source_fields] == [("Custom Tag", "legacy"), ("a", "b=c")]


def test_duplicates_and_flags(spark):
    t = tab.classify(elements(spark, [{"columns": ["ID", "Date", "Status", "Notes"], "rows": [["A", "03/04/26", "x", "a Duplicate?"], ["A", "-", "y", ""], ["B", "x", "z", "-"]]}]))
    flags = {(r.row_no): r.flags for r in tab.master_records(t).collect()}
    assert flags == {0: ["date_ambiguous", "missing_owner", "possible_duplicate", "duplicate_id"], 1: ["missing_owner", "duplicate_id"], 2: ["date_unparsed", "missing_owner"]}
    report = extract.report(t, tab.master_records(t), {"notes": tab.quality_flags(t)}).first()
    assert (report.tables_found, report.master_records, report.duplicate_ids, report.ambiguous_dates, report.notes) == (1, 3, ["A"], 1, 0)
    assert extract.row_count_warnings(t.withColumn("n_rows", F.lit(9)), tab.master_records(t)).first().warning == "master_records: parsed 3 rows but tables hold 9"


def test_monthly_flags_and_value_groups(spark):
    t = tab.classify(
        elements(
            spark,
            [
                {"columns": ["Month", "Requests", "Resolved", "CSAT", "Comment"], "rows": [["Jan", "1,000", "900", "4.5", "Data gap here"]]},
                {"columns": ["Flag", "Area", "Description"], "rows": [["F1", "x", "?"]]},
                {"columns": ["col_1"], "has_header": False, "rows": [["Traffic: 12%"], ["Region = North"]]},
                {"columns": ["col_1"], "has_header": False, "rows": [["Traffic: 12%"], ["free text"]]},
            ],
        )
    )
    assert [r["class"] for r in t.orderBy("element_no").collect()] == ["monthly", "dq", "values", "generic"]
    m = tab.monthly_performance(t).first()
    assert (m.month, m.requests, m.flags) == ("Jan", 1000, ["data_gap"])
    f = tab.quality_flags(t).first()
    assert (f.flag_id, f.severity, f.description) == ("F1", None, None)
    assert [tuple(i) for i in tab.value_groups(t).first()["items"]] == [("Traffic", "12%", 12, "%"), ("Region", "North", None, None)]


def test_split_table(spark):
    grids = [[["Title", None], ["A", "B"], ["1", "2"]], [["only"], ["x"], ["y"]], [["A", "A"], ["1", "2"]], [["", None]], [["1", "2"], ["3"]]]
    df = spark.createDataFrame(list(enumerate(grids)), "i int, raw_rows array<array<string>>")
    got = {r.i: (r.title, r.band, r["columns"], r.has_header, r.rows) for r in tab.split_table(df).collect()}
    assert got == {0: ("Title", True, ["A", "B"], True, [["1", "2"]]), 1: ("only", False, ["col_1"], False, [["x"], ["y"]]), 2: (None, False, ["A", "A_2"], True, [["1", "2"]]), 4: (None, False, ["col_1", "col_2"], False, [["1", "2"], ["3", ""]])}


def _part(no, page, rows, header=True, title=None, heading=None, top=0.0, bottom=0.0, height=0.0, columns=("A", "B"), kind="body"):
    return ("d", no, kind, list(columns), header, list(columns) if header else None, rows, title, heading, [page], 10.0, 90.0, float(top), float(bottom), float(height))


def test_stitching(spark):
    schema = "doc_id string, element_no int, kind string, columns array<string>, has_header boolean, header_row array<string>, rows array<array<string>>, title string, heading string, pages array<int>, x0 double, x1 double, top double, bottom double, page_height double"
    rows = [_part(0, 1, [["1", "2"]]), _part(1, 1, [["s", "t"]], kind="side"), _part(2, 2, [["3", "4"]], title="T (continued)"), _part(3, 3, [["5", "6"]], title="Other"), _part(4, 5, [["7", "8"]], header=False, bottom=780, height=800, columns=("col_1", "col_2")), _part(5, 6, [["9", "0"]], header=True, top=30, columns=("x", "y"))]
    out = {r.element_no: r for r in tab.stitch(spark.createDataFrame(rows, schema)).collect()}
    assert sorted(out) == [0, 1, 3, 4]
    assert out[0].rows == [["1", "2"], ["3", "4"]] and out[0].pages == [1, 2] and out[0].merged_parts == 2 and out[0].part_titles == ["T (continued)"]
    assert out[4].rows == [["7", "8"], ["x", "y"], ["9", "0"]]


def test_large_table_is_covered_once(spark):
    rows = [[f"REC-{i:05d}", "Closed"] for i in range(1, 1306)]
    df = spark.createDataFrame([("d", "t", "Table: T\nColumns: ID | Status", rows)], "doc_id string, table_id string, header string, rows array<array<string>>")
    chunks = chunk.chunk_tables(df, 120, lambda x: F.length(x).cast("bigint")).orderBy("row_start").collect()
    seen = [n for c in chunks for n in range(c.row_start, c.row_end + 1)]
    assert seen == list(range(1, 1306)) and all(c.table_chunks == len(chunks) for c in chunks)
    assert all(len(c.text) <= 120 for c in chunks) and chunks[0].text.startswith("Table: T\nColumns: ID | Status\nREC-00001 | Closed")


def test_oversized_and_empty_rows(spark):
    rows = [["short"], ["word " * 60 + "end."], ["tail"]]
    df = spark.createDataFrame([("d", "t", "H", rows), ("d", "u", "H", [])], "doc_id string, table_id string, header string, rows array<array<string>>")
    got = chunk.chunk_tables(df, 100, lambda x: F.length(x).cast("bigint")).orderBy("table_id", "table_chunk").collect()
    assert (got[-1].row_start, got[-1].row_end, got[-1].text) == (1, 0, "H")
    parts = [c for c in got if "(row 2, part" in c.text]
    assert len(parts) > 2 and sum(c.text.count("word") for c in parts) == 60
    assert [c.text for c in got if c.table_id == "t" and "part" not in c.text] == ["H\nshort", "H\ntail"]


@pytest.mark.parametrize("costs", [[], [5], [500], [100] * 9, [390, 20, 20, 390], list(range(1, 60))])
def test_packing(spark, costs):
    def greedy(limit):
        groups, used = [], 0
        for c in costs:
            if not groups or used + c > limit:
                groups.append([])
                used = 0
            groups[-1].append(c)
            used += c
        return groups

    df = spark.createDataFrame([(costs,)], "costs array<int>")
    r = chunk.balanced(df.withColumn("p", chunk.pack(F.col("costs"), F.lit(400))), "costs", F.lit(400), "b").first()
    plain = greedy(400)
    assert r.p == [g for g, items in enumerate(plain) for _ in items]
    assert len(r.b) == len(costs) and len(set(r.b)) <= len(plain)
    best = plain
    if len(plain) > 1:
        for x in (0.25, 0.5, 0.75, 1.0):
            tried = greedy(min(400, -(-sum(costs) // len(plain)) + int(x * max(costs))))
            if len(tried) <= len(plain):
                best = tried
                break
    assert r.b == [g for g, items in enumerate(best) for _ in items]


def test_text_chunks_keep_headings_with_what_follows(spark):
    base = {"doc_id": "d", "element_type": "text", "file_type": "pdf", "section": "S", "pages": [1], "page": 1, "source": "s"}
    texts = [("S", True), ("alpha beta gamma delta " * 6, False), ("short tail.", False), ("omega " * 30, False), ("Next", True), ("closing words " * 12, False)]
    df = spark.createDataFrame([tuple((base | {"element_no": i, "text": t, "is_heading": h}).get(n) for n in NAMES) for i, (t, h) in enumerate(texts)], ELEMENT)
    got = chunk.chunk_texts(chunk.sections(df), 90).orderBy("part").collect()
    assert all(c.text.startswith("Section: S\nPages: 1") for c in got)
    assert "short tail." in got[0].text and "short tail." in got[1].text  # repeated for continuity
    with_next = [c for c in got if "\nNext" in c.text]
    assert len(with_next) == 1 and "closing words" in with_next[0].text and with_next[0].has_heading
