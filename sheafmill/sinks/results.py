"""Extraction results as JSON and as a plain-text report, one file or many.

At scale results go out as one JSON object a line, or as report lines; a single document's file is
written from its own group.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..storage import settled

#: Sections of the report in order: (key, title, columns, labels).
RECORD_COLUMNS = ("record_id", "name", "department", "location", "date_raw", "date_iso", "status", "amount", "priority", "entity_site", "category", "quantity", "unit_price", "discount", "email", "phone", "product", "code", "score", "last_updated_raw", "metric_a", "metric_b", "owner", "manager", "notes", "flags")
RECORD_LABELS = {"record_id": "ID", "name": "Name", "department": "Department", "location": "Location", "date_raw": "Date", "date_iso": "Date (ISO)", "status": "Status", "amount": "Amount", "priority": "Priority", "entity_site": "Entity / Site"}
MONTHLY_COLUMNS = ("month", "requests", "resolved", "avg_hrs", "p95_hrs", "csat", "variance_pct", "comment")
FLAG_COLUMNS = ("flag_id", "area", "severity", "description")
NOTE_COLUMNS = ("date_raw", "area", "text", "verified")


def scalar(x: Column) -> Column:
    return F.coalesce(F.nullif(x.cast("string"), F.lit("")), F.lit("Not Found"))


def number(x: Column, whole: Column | None = None) -> Column:
    """A double as it was written: whole numbers without a point."""
    is_int = (x == F.floor(x)) if whole is None else F.coalesce(whole, F.lit(False))
    return F.when(is_int, x.cast("bigint").cast("string")).otherwise(x.cast("string"))


def cell(rows: DataFrame, name: str) -> Column:
    """A report cell: ``-`` for nothing, lists with commas, maps as ``k=v; k=v``."""
    kind = rows.schema[name].dataType.typeName()
    x = F.col(name)
    if kind == "array":
        text = F.array_join(x.cast("array<string>"), ", ")
    elif kind == "map":
        text = F.array_join(F.transform(F.map_entries(x), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"].cast("string"), F.lit("")))), "; ")
    elif kind == "boolean":
        text = F.initcap(x.cast("string"))
    elif kind == "double":
        text = number(x, F.col(f"{name}_is_int") if f"{name}_is_int" in rows.columns else None)
    else:
        text = x.cast("string")
    return F.coalesce(F.nullif(text, F.lit("")), F.lit("-"))


def section(docs: DataFrame, rows: DataFrame, number_: int, title: str, columns: tuple[str, ...], labels: dict[str, str] | None = None, order: str = "row_no") -> DataFrame:
    """(doc_id, section_no, row_no, line) of a table section: title with the count, rule, header, rows."""
    labels = labels or {}
    line = F.concat_ws(" | ", *[cell(rows, c) for c in columns])
    body = rows.select("doc_id", F.lit(number_).alias("section_no"), (F.col(order) + 3).cast("bigint").alias("row_no"), line.alias("line"))
    counts = docs.select("doc_id").distinct().join(rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")), "doc_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    header = F.when(F.col("n") > 0, F.lit(" | ".join(labels.get(c, c) for c in columns))).otherwise("None found")
    top = F.array(F.lit(""), F.concat(F.lit(f"{title} ("), F.col("n").cast("string"), F.lit(")")), F.lit("-" * (len(title) + 6)), header)
    heads = counts.select("doc_id", F.lit(number_).alias("section_no"), F.posexplode(top).alias("p", "line")).select("doc_id", "section_no", (F.col("p") - 1).cast("bigint").alias("row_no"), "line")
    return heads.unionByName(body)


def pairs_section(pairs: DataFrame, number_: int, title: str, rule: int) -> DataFrame:
    """A section of ``Name: value`` lines from (doc_id, row_no, name, value)."""
    docs = pairs.select("doc_id").distinct()
    heads = docs.select("doc_id", F.posexplode(F.array(F.lit(""), F.lit(title), F.lit("-" * rule))).alias("p", "line")).select("doc_id", F.lit(number_).alias("section_no"), (F.col("p") - 3).cast("bigint").alias("row_no"), "line")
    lines = pairs.select("doc_id", F.lit(number_).alias("section_no"), F.col("row_no").cast("bigint").alias("row_no"), F.concat("name", F.lit(": "), scalar(F.col("value"))).alias("line"))
    return heads.unionByName(lines)


#: Sections of the report in order: title and the table that it counts.
COUNTED = (("Master Records", "records"), ("Monthly Performance", "monthly"), ("Value Groups", "value_groups"), ("Data Quality Flags", "quality_flags"), ("Field Notes", "notes"), ("Ancillary Tables", "ancillary"))
#: Counts of the extraction report in order; those of sections are counted anew.
REPORTED = ("tables_found", "master_records", "monthly_performance", "value_groups", "data_quality_flags", "field_notes", "ancillary_tables", "stitched_tables", "duplicate_ids", "ambiguous_dates")


def _numbered(lines: DataFrame, section_no: int, *order: str) -> DataFrame:
    """Lines (doc_id, line) of a section in an order."""
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy(*order)).cast("bigint")
    return lines.withColumn("row_no", place).select("doc_id", F.lit(section_no).alias("section_no"), "row_no", "line")


def _titled(names: list[str]) -> list[str]:
    return [n.replace("_", " ").title() for n in names]


def _fields(docs: DataFrame, section_no: int, title: str, columns: list[str]) -> DataFrame:
    """A section of ``Name: value`` lines, one for each of a document's columns."""
    value = lambda c: F.coalesce(F.nullif(cell(docs, c), F.lit("-")), F.lit("Not Found"))
    lines = [F.lit(""), F.lit(title), F.lit("-" * len(title)), *[F.concat(F.lit(f"{n}: "), value(c)) for n, c in zip(_titled(columns), columns, strict=True)]]
    return docs.select("doc_id", F.lit(section_no).alias("section_no"), F.posexplode(F.array(*lines)).alias("p", "line")).select("doc_id", "section_no", F.col("p").cast("bigint").alias("row_no"), "line")


def _counted_head(docs: DataFrame, rows: DataFrame, section_no: int, title: str, rule: int, always: bool = True) -> DataFrame:
    """The head of a section of free lines: its title with the number of things in it, and a rule."""
    n = docs.join(rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")), "doc_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    n = n if always else n.where("n > 0")
    top = F.array(F.lit(""), F.concat(F.lit(f"{title} ("), F.col("n").cast("string"), F.lit(")")), F.lit("-" * rule))
    return n.select("doc_id", F.lit(section_no).alias("section_no"), F.posexplode(top).alias("p", "line")).select("doc_id", "section_no", (F.col("p") - 3).cast("bigint").alias("row_no"), "line")


def _plain(x: Column) -> Column:
    return F.coalesce(F.nullif(x, F.lit("")), F.lit("-"))


def report_lines(result) -> DataFrame:
    """(doc_id, section_no, row_no, line): the whole report of each document of a pipeline's result."""
    docs = result.info.select("doc_id").distinct()
    counts = docs
    for _, name in COUNTED:
        counts = counts.join(getattr(result, name).groupBy("doc_id").agg(F.count(F.lit(1)).alias(f"n_{name}")), "doc_id", "left")
    counts = counts.na.fill(0)
    summary = [F.lit("STRUCTURED DOCUMENT EXTRACTION"), F.lit("=" * 32), F.concat(F.lit("Source: "), F.col("doc_id")), F.lit(""), F.lit("EXTRACTION SUMMARY"), F.lit("-" * 18), *[F.concat(F.lit(f"{title}: "), F.col(f"n_{name}").cast("string")) for title, name in COUNTED]]
    top = counts.select("doc_id", F.lit(0).alias("section_no"), F.posexplode(F.array(*summary)).alias("p", "line")).select("doc_id", "section_no", F.col("p").cast("bigint").alias("row_no"), "line")
    own = {title.lower().replace(" ", "_"): F.col(f"n_{name}") for title, name in COUNTED}
    both = counts.join(result.report, "doc_id", "left")
    reported = both.select("doc_id", *[own.get(c, F.col(c)).alias(c) for c in REPORTED if c in own or c in result.report.columns]).na.fill(0)

    groups = result.value_groups.withColumn("__k", F.row_number().over(Window.partitionBy("doc_id").orderBy("table_id")))
    items = groups.select("doc_id", "__k", F.posexplode("items").alias("p", "item")).select("doc_id", "__k", "p", F.concat(F.lit("  "), F.col("item.label"), F.lit(": "), F.col("item.value_raw")).alias("line"))
    group_lines = groups.select("doc_id", "__k", F.lit(-1).alias("p"), F.concat(F.lit("["), scalar(F.col("title")), F.lit("]")).alias("line")).unionByName(items)

    pages = result.transcripts.select("doc_id", "row_no", F.posexplode(F.flatten(F.array(F.array(F.lit(""), F.concat(F.lit("Page "), scalar(F.col("page_number"))), F.lit("-" * 20)), F.split(F.coalesce("text", F.lit("")), "\n")))).alias("p", "line"))

    rest = result.ancillary.withColumn("__k", F.row_number().over(Window.partitionBy("doc_id").orderBy("table_id", "table_name")))
    sheet = F.concat(F.lit("Sheet "), F.col("sheet_name"), F.when(F.col("block_range").isNotNull(), F.concat(F.lit(", "), F.col("block_range"))).otherwise(""))
    place = F.when(F.nullif("sheet_name", F.lit("")).isNotNull(), sheet).otherwise(F.concat(F.lit("Page "), scalar(F.col("page_number"))))
    headers = F.when(F.size("headers") > 0, F.array_join(F.transform("headers", _plain), " | ")).otherwise("(none)")
    body = F.when(F.size("rows") > 0, F.transform("rows", lambda r: F.array_join(F.transform(r, _plain), " | "))).otherwise(F.array(F.lit("None found")))
    table_lines = F.concat(F.array(F.lit(""), F.concat("table_name", F.lit(" ("), place, F.lit(")")), F.repeat(F.lit("-"), F.length("table_name") + 16), F.concat(F.lit("Headers: "), headers)), body)
    rest_lines = rest.select("doc_id", "__k", F.posexplode(table_lines).alias("p", "line"))

    warned = result.warnings.join(docs, "doc_id", "left_semi").select("doc_id", "warning").distinct()
    warning_head = warned.select("doc_id").distinct().select("doc_id", F.lit(10).alias("section_no"), F.posexplode(F.array(F.lit(""), F.lit("WARNINGS"), F.lit("-" * 8))).alias("p", "line")).select("doc_id", "section_no", (F.col("p") - 3).cast("bigint").alias("row_no"), "line")

    def ordered(rows: DataFrame) -> DataFrame:
        """One numbering for all of a document's rows, by table and place."""
        order = [c for c in ("table_id", "row_no", "note_no") if c in rows.columns]
        return rows.withColumn("row_no", F.row_number().over(Window.partitionBy("doc_id").orderBy(*order)) - 1)

    parts = [
        top,
        _fields(result.info, 1, "DOCUMENT INFO", [c for c in result.info.columns if c != "doc_id"]),
        _fields(reported, 2, "EXTRACTION REPORT", [c for c in reported.columns if c != "doc_id"]),
        section(docs, ordered(result.records), 3, "MASTER RECORDS", RECORD_COLUMNS, RECORD_LABELS),
        section(docs, ordered(result.monthly), 4, "MONTHLY PERFORMANCE", MONTHLY_COLUMNS),
        _counted_head(docs, groups, 5, "VALUE GROUPS", 15), _numbered(group_lines, 5, "__k", "p"),
        section(docs, ordered(result.quality_flags), 6, "DATA QUALITY FLAGS", FLAG_COLUMNS),
        section(docs, ordered(result.notes), 7, "FIELD NOTES", NOTE_COLUMNS),
        _counted_head(docs, result.transcripts, 8, "OCR TRANSCRIPTS", 15, always=False), _numbered(pages, 8, "row_no", "p"),
        _counted_head(docs, rest, 9, "ANCILLARY TABLES", 17), _numbered(rest_lines, 9, "__k", "p"),
        warning_head, _numbered(warned.withColumn("line", F.concat(F.lit("- "), "warning")), 10, "warning"),
    ]
    return reduce(DataFrame.unionByName, parts)


def reports(lines: DataFrame) -> DataFrame:
    """(doc_id, report): each document's lines as one text."""
    by = F.array_sort(F.collect_list(F.struct("section_no", "row_no", "line")))
    return lines.groupBy("doc_id").agg(F.concat(F.array_join(F.transform(by, lambda x: x["line"]), "\n"), F.lit("\n")).alias("report"))


def write_report(lines: DataFrame, path: str) -> None:
    """Reports as a table (doc_id, report), many documents to a file."""
    reports(lines).write.parquet(path)


def documents_json(result) -> DataFrame:
    """(doc_id, json): everything that was extracted of each document, as one indented object."""
    out = result.info.select("doc_id", F.struct(*[c for c in result.info.columns if c != "doc_id"]).alias("document_info"))
    names = {"master_records": "records", "monthly_performance": "monthly", "value_groups": "value_groups", "data_quality_flags": "quality_flags", "field_notes": "notes", "ocr_text": "transcripts", "ancillary_tables": "ancillary"}
    for name, table in names.items():
        rows = getattr(result, table)
        keys = [c for c in ("table_id", "row_no", "note_no", "table_name") if c in rows.columns]
        kept = [c for c in rows.columns if c != "doc_id" and c not in ("row_no", "note_no") and not c.endswith("_is_int")]
        item = F.struct(*[F.col(c).alias(f"__{i}") for i, c in enumerate(keys)], F.to_json(F.struct(*kept), {"ignoreNullFields": "false"}).alias("x"))
        grouped = rows.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(item)), lambda r: r["x"]).alias(name))
        out = out.join(grouped, "doc_id", "left")
    warned = result.warnings.groupBy("doc_id").agg(F.sort_array(F.collect_set("warning")).alias("warnings"))
    out = out.join(warned, "doc_id", "left").join(result.report.select("doc_id", F.struct(*[c for c in result.report.columns if c != "doc_id"]).alias("report")), "doc_id", "left")
    return out.select("doc_id", F.to_json(F.struct(F.col("doc_id").alias("source_file"), *[c for c in out.columns if c != "doc_id"]), {"ignoreNullFields": "false"}).alias("packed"), F.array(*map(F.lit, names)).alias("lists")).select("doc_id", _unpacked("packed", "lists").alias("json"))


@F.pandas_udf(StringType())
def _unpacked(packed: pd.Series, lists: pd.Series) -> pd.Series:
    """Lists of objects that were packed as texts, opened, and the whole indented."""
    out = []
    for text, names in zip(packed, lists, strict=True):
        whole = json.loads(text)
        for name in names:
            whole[name] = [json.loads(x) for x in whole.get(name) or []]
        out.append(json.dumps(whole, ensure_ascii=False, indent=2))
    return pd.Series(out)


def write_pairs(result, folder: str) -> DataFrame:
    """``{stem}_extracted.json`` and ``.txt`` of each document under ``folder``; (doc_id, json_path, txt_path) of what was written.

    ``folder`` is a path or URI that every executor can write. A file appears whole, and one that
    is written again replaces the first, so a task may run twice.
    """
    both = documents_json(result).join(reports(report_lines(result)), "doc_id").withColumns({"json_path": output_name(F.col("doc_id"), ".json"), "txt_path": output_name(F.col("doc_id"), ".txt")})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for frame in frames:
            store, root = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
            store.create_dir(root, recursive=True)
            for text, name in [*zip(frame["json"], frame["json_path"], strict=True), *zip(frame["report"], frame["txt_path"], strict=True)]:
                own = f"{root}/.{uuid.uuid4().hex}"
                with store.open_output_stream(own) as out:
                    out.write(text.encode())
                store.move(own, f"{root}/{name}")
            yield frame[["doc_id", "json_path", "txt_path"]]

    return settled(both.select("doc_id", "json", "report", "json_path", "txt_path").mapInPandas(run, "doc_id string, json_path string, txt_path string"), "written")


def write_json(results: DataFrame, path: str) -> None:
    """One object a line; absent values are written as null and other alphabets as they are."""
    results.write.option("ignoreNullFields", "false").json(path)


def pretty(result: Column) -> Column:
    """A result as indented JSON with its fields in order."""
    return F.to_json(result, {"pretty": "true", "ignoreNullFields": "false"})


def output_name(path: Column, ending: str) -> Column:
    """``{stem}_extracted`` and an ending."""
    return F.concat(F.regexp_extract(path, r"([^/\\]*?)(\.[^./\\]*)?$", 1), F.lit(f"_extracted{ending}"))
