import contextlib
import hashlib
import io
import json
import math
import random
import re
import sys
import types
import zipfile

import pytest
from pyspark.sql import functions as F

from sheafmill.operators import extract, models, tables
from sheafmill.plans import pipeline
from sheafmill.sinks import results
from sheafmill.sources import docx, excel, files, ocr
from sheafmill.streaming import arrivals

from .books import DATE, PERCENT, document, grid, workbook
from .pages import Page, words

HEAD = ["ID", "Date", "Region", "Team", "Metric A", "Metric B", "Status", "Owner", "Notes"]


def test_blocks_dates_percent_and_formulas():
    primary = {(1, 1): "Master title"} | grid([HEAD, ["R-1", (46000, DATE), "North", "Sales", (0.1256, PERCENT), 2, "Open", "Ari", "keep"]], 2) | grid([["Left", "Right"], ["x", ("=SUM(1,2)",)]], 5) | {(8, 1): "Note", (9, 1): "free text"}
    raw = grid([["Key", "Value"], ["a", "123456789.1234568"], ["b", 123456789.1234568]])
    out = excel.parse("/x/book.xlsx", workbook({"Primary": (primary, ["A1:I1"]), "Raw Imports": (raw, [])}))
    tables = [e for e in out if e["element_type"] == "table"]
    assert [t["block_range"] for t in tables] == ["Primary!A1:I3", "Primary!A5:B6", "'Raw Imports'!A1:B3"]
    assert tables[0]["title"] == "Master title" and tables[0]["rows"] == [["R-1", "2025-12-09", "North", "Sales", "12.56%", "2", "Open", "Ari", "keep"]]
    assert tables[1]["rows"] == [["x", "=SUM(1,2)"]] and tables[2]["rows"][1] == ["b", "123456789.1234568"] and tables[2]["secondary_sheet"]
    assert [e["text"] for e in out if e["element_type"] == "text"] == ["Note\nfree text"]
    assert {e["file_type"] for e in excel.parse("/x/book.xlsm", workbook({"P": (raw, [])}))} == {"xlsm"}


def test_merged_data_and_grouped_headers():
    out = excel.parse("b.xlsx", workbook({"S": (grid([["ID", "Name"], ["Shared", "a"], [None, "b"]]), ["A2:A3"])}))
    assert out[0]["rows"] == [["Shared", "a"], ["Shared", "b"]]
    out = excel.parse("b.xlsx", workbook({"S": (grid([["ID", "Financial", None], ["ID", "Budget", "Actual"], ["1", 5, 6]]), ["B1:C1"])}))
    assert out[0]["columns"] == ["ID", "Financial / Budget", "Financial / Actual"] and out[0]["rows"] == [["1", "5", "6"]]


def test_side_block_takes_the_title_above():
    side = {(93, 25): "Side title"} | grid([["Code", "B", "C", "D", "E", "F"], *[[f"VAL-{i}", "x", "x", "x", "x", "x"] for i in range(16)]], 95, 25)
    out = excel.parse("b.xlsx", workbook({"S": (grid([["ID", "Name"], *[[f"r{i}", "n"] for i in range(20)]]) | side, ["Y93:AD93"])}))
    block = next(e for e in out if e.get("title") == "Side title")
    assert block["block_range"] == "S!Y95:AD111" and block["rows"][-1][0] == "VAL-15"


def test_timestamp_column_is_dated():
    out = excel.parse("b.xlsx", workbook({"S": (grid([["ID", "Timestamp"], ["a", 45659.5]]), [])}))
    assert out[0]["rows"] == [["a", "2025-01-02"]]


def test_word_caption_heading_and_split_table():
    rows = [["Region", "Sales"], ["North", "10"]]
    out = docx.parse("d.docx", document([("h", "Results"), ("p", "Long text " * 20), ("p", "Table 1: Sales"), ("t", rows), ("t", [["Region", "Sales"], ["South", "4"]]), ("b", "Bold heading"), ("t", [["a", "b"], ["1", "2"], ["3", "4"]])]))
    tables = [e for e in out if e["element_type"] == "table"]
    assert tables[0]["title"] == "Table 1: Sales" and tables[0]["rows"] == [["North", "10"], ["South", "4"]] and tables[0]["merged_parts"] == 2
    assert tables[1]["heading"] == "Bold heading" and tables[1]["section"] == "Bold heading"
    assert out[0]["is_heading"] and out[1]["section"] == "Results"


def test_a_merged_column_is_filled_as_far_as_there_are_rows():
    cells = grid([["Key", "Value"], ["a", "1"], ["", "2"], ["", "3"]])
    out = excel.parse("/x/b.xlsx", workbook({"S": (cells, ["A2:A1048576"])}))
    assert [e["rows"] for e in out if e["element_type"] == "table"] == [[["a", "1"], ["a", "2"], ["a", "3"]]]


def write(folder):
    (folder / "good.xlsx").write_bytes(workbook({"Sales": (grid([["ID", "Date", "Status", "Amount", "Owner"], *[[f"R-{i}", "2026-01-0%d" % (i % 9 + 1), "Open", 5 * i, "Ari"] for i in range(1, 30)]]), [])}))
    (folder / "notes.docx").write_bytes(document([("h", "Field notes"), ("p", "3 May | North | pump ok"), ("p", "4 May | South | valve loose"), ("p", "5 May | East | all quiet"), ("h", "About"), ("p", "Prepared by Ada Lovelace, Analytical Society. Contact ada@example.org")]))
    (folder / "old.doc").write_bytes(b"x")
    (folder / "broken.xlsx").write_bytes(b"not a zip")


def test_files_to_results(spark, tmp_path):
    write(tmp_path)
    elements = files.read_files(spark, str(tmp_path)).persist()
    assert {r.error.split(":")[0] for r in files.errors(elements).collect()} == {"ingestion failed"} and files.errors(elements).count() == 2
    calls = spark.sparkContext.accumulator(0)

    def model(kind, context):
        calls.add(1)
        return {"name": "Ada Lovelace", "organization": "Invented Ltd", "email": "ada@example.org", "summary": "anything"}

    r = pipeline.extract_all(elements, model, "fake")
    assert r.records.count() == 29 and {x.amount for x in r.records.collect()} == {5.0 * i for i in range(1, 30)}
    info = {x.doc_id.rsplit("/", 1)[-1]: x for x in r.info.collect()}["notes.docx"]
    assert (info.name, info.organization, info.email, info.summary) == ("Ada Lovelace", None, "ada@example.org", "anything")
    assert any("'Invented Ltd' not found in source" in w.warning for w in r.warnings.collect())
    assert [(n.area, n.verified) for n in r.notes.orderBy("note_no").collect()] == [("North", True), ("South", True), ("East", True)]
    report = {x.doc_id.rsplit("/", 1)[-1]: x for x in r.report.collect()}["good.xlsx"]
    assert (report.master_records, report.tables_found, report.ancillary_tables) == (29, 1, 0)
    assert pipeline.needs_retry(r).count() == 0
    chunks = r.chunks.withColumns({"chunk_index": F.col("chunk_index")})
    said = pipeline.answer(chunks, spark.createDataFrame([(1, "valve loose South")], "query_id int, query string"), lambda q, p: p.split("\n")[0]).first()
    assert said.answer.startswith("[Field notes") and said.cited
    lines = results.section(r.tables, r.records, 1, "MASTER RECORDS", results.RECORD_COLUMNS, results.RECORD_LABELS).where("doc_id like '%good%'").orderBy("row_no").collect()
    assert lines[1].line == "MASTER RECORDS (29)" and lines[3].line.startswith("ID | Name") and len(lines) == 33 and lines[4].line.startswith("R-1 | - | -")
    results.write_json(r.records, f"{tmp_path}/out/json")
    assert spark.read.json(f"{tmp_path}/out/json").count() == 29
    results.write_report(results.section(r.tables, r.records, 1, "R", ("record_id",)), f"{tmp_path}/out/txt")
    assert spark.read.parquet(f"{tmp_path}/out/txt").count() == r.tables.select("doc_id").distinct().count()


def test_a_file_pair_for_each_document(spark, tmp_path):
    write(tmp_path)
    kept = f"{tmp_path}/kept"
    asked = spark.sparkContext.accumulator(0)

    def model(kind, context):
        asked.add(1)
        return {"name": "Ada Lovelace", "organization": "Invented Ltd"}

    elements = files.read_files(spark, f"{tmp_path}/*.*")
    r = pipeline.extract_with_retries(elements, model, "fake", kept=kept)
    once = asked.value
    written = {x.doc_id.rsplit("/", 1)[-1]: x for x in results.write_pairs(r, f"{tmp_path}/pairs").collect()}
    assert {p.name for p in (tmp_path / "pairs").iterdir()} == {f"{s}_extracted{e}" for s in ("good", "notes") for e in (".json", ".txt")}
    assert written["good.xlsx"].json_path == "good_extracted.json"
    whole = json.loads((tmp_path / "pairs" / "good_extracted.json").read_text())
    assert len(whole["master_records"]) == 29 and whole["master_records"][0]["record_id"] == "R-1" and whole["report"]["tables_found"] == 1
    notes = json.loads((tmp_path / "pairs" / "notes_extracted.json").read_text())
    assert [n["area"] for n in notes["field_notes"]] == ["North", "South", "East"] and notes["document_info"]["name"] == "Ada Lovelace"
    assert any("Invented Ltd" in w for w in notes["warnings"])
    lines = (tmp_path / "pairs" / "good_extracted.txt").read_text().split("\n")
    heads = [x for x in lines if x.isupper() or re.fullmatch(r"[A-Z ]+ \(\d+\)", x)]
    assert heads[:11] == ["STRUCTURED DOCUMENT EXTRACTION", "EXTRACTION SUMMARY", "DOCUMENT INFO", "EXTRACTION REPORT", "MASTER RECORDS (29)", "MONTHLY PERFORMANCE (0)", "VALUE GROUPS (0)", "DATA QUALITY FLAGS (0)", "FIELD NOTES (0)", "ANCILLARY TABLES (0)", "WARNINGS"]
    assert "Master Records: 29" in lines and "Tables Found: 1" in lines and "Title: Not Found" in lines and "Ambiguous Dates: 0" in lines and "Duplicate Ids: Not Found" in lines
    assert sum(x.startswith("R-") and x.count(" | ") == 25 for x in lines) == 29
    # What was answered is kept: the same documents ask nothing.
    pipeline.extract_all(elements, model, "fake", kept=kept).info.collect()
    assert asked.value == once


def test_documents_that_failed_are_looked_at_again(spark, tmp_path):
    write(tmp_path)

    def model(kind, context):
        if not (tmp_path / "failed").exists():
            (tmp_path / "failed").write_text("once")
            raise ValueError("cut off")
        return {"name": "Ada Lovelace"}

    r = pipeline.extract_with_retries(files.read_files(spark, f"{tmp_path}/*.docx"), model, "fake", attempts=2)
    assert [x.name for x in r.info.collect()] == ["Ada Lovelace"] and not [w for w in r.warnings.collect() if "failed" in w.warning]
    assert r.notes.count() == 3 and r.elements.select("doc_id").distinct().count() == 1


def test_answers_by_schema_and_providers():
    said = {"document_info": "Sure: {\"title\": \"T\", \"other\": 1}", "field_notes": "{\"notes\": [{\"text\": \"x\"}]}"}
    ask = lambda prompt: said["field_notes" if "observation" in prompt.split("\n")[0] else "document_info"]
    model = models.structured(ask)
    info = model("document_info", "context")
    assert info["title"] == "T" and info["name"] is None and "other" not in info
    assert model("field_notes", "context") == {"notes": [{"text": "x"}]}
    with pytest.raises(ValueError):
        models.parsed("document_info", "no object")
    with pytest.raises(ValueError):
        models.chat("unheard", "m")
    with pytest.raises(ValueError, match="needs langchain_groq"):
        models.chat("groq", "m")("hello")

    class Busy(Exception):
        status_code = 429

    assert extract.is_quota_error(Busy("slow down")) and not extract.is_quota_error(ValueError("x"))


def test_records_are_promoted(spark):
    header = ["ID", "Date", "Status", "Full Name", "Urgency", "Custom"]
    t = [("d", 0, "table", "pdf", "t001", "T", None, False, header, header, [["R-1", "2026-01-02", "Open", "Ari", "High", "legacy"]], True, 1, ["x"], 1)]
    kind = "doc_id string, element_no int, element_type string, file_type string, table_id string, title string, section string, secondary_sheet boolean, columns array<string>, headers array<string>, rows array<array<string>>, has_header boolean, page int, source array<string>, n_rows int"
    df = spark.createDataFrame(t, kind).withColumn("source", F.lit("f")).withColumns({c: F.lit(None).cast("string") for c in ("file_name", "sheet_name", "block_range", "text", "heading")}).withColumns({"pages": F.array(F.lit(1)), "sheet_index": F.lit(None).cast("int")})
    r = extract.promote_records(tables.master_records(tables.classify(df))).first()
    assert (r.name, r.priority, r.source_fields) == ("Ari", "High", {"Custom": "legacy"})


def fused_by_hand(chunks, queries, kept, k):
    """The places of a document's best chunks by hashed vectors, BM25 and identifiers, one number after another."""

    def vector(text):
        words, out = re.findall("[a-z0-9]+", text.lower()), [0.0] * 384
        for gram in words + [w[i : i + 4] for w in words for i in range(max(1, len(w) - 3))]:
            digest = hashlib.md5(gram.encode()).digest()
            out[int.from_bytes(digest[:4], "little") % 384] += 1.0 if digest[4] & 1 else -1.0
        norm = math.sqrt(sum(x * x for x in out)) or 1.0
        return [x / norm for x in out]

    bags = [re.findall("[a-z0-9]+", c.lower()) for c in chunks]
    fused, n, mean = {}, len(chunks), sum(map(len, bags)) / len(bags)
    for query, ids in queries:
        q, dense, lexical, exact = vector(query), [], [0.0] * n, [0.0] * n
        dense = [sum(a * b for a, b in zip(q, vector(c), strict=True)) for c in chunks]
        for term in set(re.findall("[a-z0-9]+", query.lower())):
            df = sum(term in b for b in bags)
            for i, b in enumerate(bags):
                tf = b.count(term)
                lexical[i] += math.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len(b) / mean))
        for token in ids:
            hits = [i for i, b in enumerate(bags) if token in b]
            for i in hits:
                exact[i] += math.log(1 + n / (1 + len(hits)))
        for scores, floor in ((dense, -1.0), (lexical, 0.0), (exact, 0.0)):
            order = sorted((i for i in kept if round(scores[i], 9) > floor), key=lambda i: (-round(scores[i], 9), i))
            for rank, i in enumerate(order[:40], 1):
                fused[i] = fused.get(i, 0.0) + 1 / (60 + rank)
    return sorted(sorted(fused, key=lambda i: (-round(fused[i], 12), i))[:k])


def test_documents_are_searched_by_all_rankers(spark):
    rng, words = random.Random(4), "pompe vanne nord ouverte calme relevé mesure jour usine zone".split()
    other = [" ".join(rng.choices(words, k=6)) for _ in range(9)]
    plain = [" ".join(rng.choices([*words, "pump", "valve", "GGN", "77b", "noted"], k=8)) for _ in range(12)]
    bodies = {"other": other, "plain": plain, "blank": ["", "…"]}
    rows = [(d, i, t, "table" if i % 4 == 3 else "text") for d, ts in bodies.items() for i, t in enumerate(ts)]
    chunks = spark.createDataFrame(rows, "doc_id string, chunk_index int, text string, element_type string")
    queries = [("pump valve noted GGN", ["ggn"]), ("observations near 77B", ["77b"])]
    asked = spark.createDataFrame([(i, q) for i, (q, _) in enumerate(queries)], "q int, query string")
    got = {}
    for r in pipeline.search_each(chunks, chunks.select("doc_id").distinct(), asked, pipeline.TEXTS, 4).collect():
        got.setdefault(r.doc_id, []).append(r.chunk_index)
    plainly = {d: fused_by_hand(ts, queries, [i for i in range(len(ts)) if i % 4 != 3], 4) for d, ts in bodies.items() if d != "blank"}
    assert {d: sorted(x) for d, x in got.items()} == plainly | {"blank": [0, 1]}


def test_a_model_without_quota_is_asked_once(spark):
    contexts = spark.createDataFrame([(f"d{i}", "document_info", f"c{i % 2}") for i in range(4)], "doc_id string, kind string, context string").coalesce(1)

    def broke(kind, context):
        raise RuntimeError("429 RESOURCE_EXHAUSTED")

    rows = extract.ask_model(contexts, broke, "m").collect()
    assert len(rows) == 4 and all(r.answer is None for r in rows)
    assert sum("skipped: LLM quota exhausted" in r.error for r in rows) == 2
    cached = extract.ask_model(contexts, lambda k, c: {"name": c}, "m")
    assert {r.answer["name"] for r in cached.collect()} == {"c0", "c1"}
    again = extract.ask_model(contexts, broke, "m", cache=cached.select("key", "answer").dropDuplicates(["key"]))
    assert all(r.error is None for r in again.collect())


def test_notes_that_are_no_piped_lines_are_asked_for(spark, tmp_path):
    def note(name, *body):
        (tmp_path / name).write_bytes(document([("h", "Field notes"), *[("p", x) for x in body]]))

    note("free.docx", "On 3 May the pump was loud.", "Later the valve leaked.")
    note("piped.docx", "3 May | North | pump ok", "4 May | South | valve loose", "5 May | East | all quiet")
    note("bad.docx", "Unreadable answer here.")
    note("long.docx", "x" * 13_000)
    (tmp_path / "grid.xlsx").write_bytes(workbook({"S": (grid([["Left", "Right"], ["x", "y"]]), [])}))

    def model(kind, context):
        if kind == "document_info":
            return {"title": "Field notes"}
        if "pump ok" in context:
            raise ValueError("asked although the lines are noted")
        return {"notes": "nonsense"} if "Unreadable" in context else {"notes": [{"date_raw": "3 May", "area": None, "text": "the pump was loud"}, {"text": "an invented one"}]}

    r = pipeline.extract_all(files.read_files(spark, str(tmp_path)), model, "fake")
    notes = [(n.doc_id.rsplit("/", 1)[-1], n.note_no, n.date_raw, n.text, n.verified) for n in r.notes.orderBy("doc_id", "note_no").collect()]
    assert [n for n in notes if n[0] == "free.docx"] == [("free.docx", 0, "3 May", "the pump was loud", True), ("free.docx", 1, None, "an invented one", False)]
    assert [n[3] for n in notes if n[0] == "piped.docx"] == ["pump ok", "valve loose", "all quiet"] and {n[0] for n in notes} <= {"free.docx", "piped.docx", "long.docx"}
    said = {(w.doc_id.rsplit("/", 1)[-1], w.warning) for w in r.warnings.collect()}
    assert ("free.docx", "field note not found verbatim in source: 'an invented one'") in said
    assert ("bad.docx", "field_notes extraction failed: the answer's notes can't be read") in said and ("grid.xlsx", pipeline.NO_CONTEXT) in said
    assert len({x.doc_id for x in r.info.collect()}) == r.info.count() == 5
    assert ("long.docx", pipeline.NO_CONTEXT) in said
    assert {x.doc_id.rsplit("/", 1)[-1] for x in pipeline.needs_retry(r).collect()} == {"bad.docx", "long.docx"}


def test_pictures_are_read_while_loading(monkeypatch):
    monkeypatch.setattr(ocr, "resolve", lambda backend="auto": "fake")
    monkeypatch.setattr(ocr, "engine", lambda backend: lambda content: f"read   from\n\n{content.decode()} of the file")
    plain, out = document([("p", "Body")]), io.BytesIO(b"")
    with zipfile.ZipFile(io.BytesIO(plain)) as old, zipfile.ZipFile(out, "w") as new:
        new.writestr("word/document.xml", old.read("word/document.xml"))
        new.writestr("word/media/image1.png", b"picture one")
    found = files.load_one("/x/a.docx", out.getvalue())
    assert [(e["element_type"], e["text"]) for e in found] == [("text", "Body"), ("ocr_text", "read from\npicture one of the file")]

    box = lambda x0, x1: {"x0": x0, "x1": x1, "top": 0, "bottom": 800}
    prose = lambda n: [w for k in range(n) for w in words("several words of prose on a line", 50, 100 + 12 * k)]
    pages = [Page(name="scan"), Page(prose(20), images=[box(100, 200), box(0, 10)], name="figure"), Page(prose(3), images=[box(0, 300)], name="half")]
    book = types.SimpleNamespace(open=lambda content: contextlib.nullcontext(types.SimpleNamespace(pages=pages)))
    monkeypatch.setitem(sys.modules, "pdfplumber", book)
    found = files.load_one("/x/a.pdf", b"")
    assert [(e["page"], e["text"].split("\n")[-1]) for e in found if e["element_type"] == "ocr_text"] == [(1, "scan of the file"), (2, "figure at 100 of the file"), (3, "half of the file")]


def test_retries_and_fallback():
    naps, calls = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise ValueError("later")
        return {"ok": "1"}

    assert extract.retried(flaky, sleep=naps.append) == {"ok": "1"} and naps == [1.5, 3.0]

    def out_of_quota(kind, context):
        raise RuntimeError("RESOURCE_EXHAUSTED")

    assert extract.with_fallback(out_of_quota, lambda: lambda k, c: {"from": "second"})("k", "c") == {"from": "second"}


def test_pictures_are_read_once(spark):
    images = spark.createDataFrame([(1, bytearray(b"a")), (2, bytearray(b"a")), (3, bytearray(b"bad"))], "i int, content binary")

    def read(content):
        if content == b"bad":
            raise ValueError("no")
        return "  two   words \n\n x"

    rows = {r.i: r.ocr_text for r in ocr.recognise(images, own=read).collect()}
    assert rows == {1: "two words\nx", 2: "two words\nx", 3: ""} and ocr.resolve("none") == "none"


def test_arriving_files(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    write(source)
    where = (str(source), str(tmp_path / "out"), str(tmp_path / "state"))
    arrivals.ingest(spark, *where).awaitTermination(120)
    first = spark.read.parquet(f"{where[1]}/elements").count()
    (source / "more.docx").write_bytes(document([("p", "one paragraph")]))
    arrivals.ingest(spark, *where).awaitTermination(120)
    assert spark.read.parquet(f"{where[1]}/elements").count() == first + 1 and spark.read.parquet(f"{where[1]}/errors").count() == 2
