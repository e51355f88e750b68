"""Tables: from raw grids to headers and rows, to typed records, and to text.

A table is a row: columns ARRAY<STRING>, rows ARRAY<ARRAY<STRING>>, has_header, and where it
stands. Everything is expressions on that row, but for the assignment of columns to fields, which
is made once for each distinct header, and for stitching, which folds a document's tables.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..schemas import MASTER, NUMBERS
from .folds import fold_groups

# The header names that stand for each field, in order of preference.
MASTER_ALIASES = {
    "record_id": ("id", "record id", "record", "ticket id", "ref", "reference", "case id", "transaction id"),
    "name": ("name", "full name", "customer", "customer name", "employee", "employee name"),
    "date_raw": ("date", "record date", "event date", "timestamp", "created date", "updated date", "last updated", "order date", "transaction date"),
    "entity_site": ("entity site", "entity", "site", "region", "branch"),
    "location": ("location", "office", "city"),
    "department": ("department", "dept", "business unit", "division", "team"),
    "category": ("category", "type", "class", "classification"),
    "amount": ("amount", "total amount", "sales", "revenue", "total"),
    "quantity": ("quantity", "qty", "units", "count"),
    "unit_price": ("unit price", "price per unit", "unit cost"),
    "discount": ("discount", "discount pct", "discount percent", "discount amount"),
    "priority": ("priority", "urgency"),
    "email": ("email", "email address"),
    "phone": ("phone", "phone number", "telephone"),
    "product": ("product", "item", "service"),
    "code": ("code", "product code", "sku"),
    "score": ("score", "rating"),
    "last_updated_raw": ("last updated", "updated at", "modified date"),
    "metric_a": ("metric a", "amount", "value", "total"),
    "metric_b": ("metric b", "measure b"),
    "status": ("status", "record status", "state"),
    "owner": ("owner", "assignee", "assigned to", "assigned group"),
    "manager": ("manager", "supervisor", "lead"),
    "notes": ("notes", "note", "remarks", "comment", "comments"),
}
MONTHLY_ALIASES = {
    "month": ("month", "period"),
    "requests": ("requests", "volume", "request count", "total requests"),
    "resolved": ("resolved", "closed", "completed", "resolved count"),
    "avg_hrs": ("avg hrs", "avg hours", "average hours"),
    "p95_hrs": ("p95 hrs", "p95 hours", "p95"),
    "csat": ("csat", "satisfaction", "customer satisfaction"),
    "variance_pct": ("variance", "variance pct", "variance percent"),
    "comment": ("comment", "comments", "notes"),
}
DQ_ALIASES = {
    "flag_id": ("flag", "flag id", "id"),
    "area": ("area",),
    "severity": ("severity", "priority"),
    "description": ("description", "details"),
}
#: Fields of which four make a table of records.
IDENTITY = ("record_id", "date_raw", "status", "entity_site", "department", "amount")


# ---- grids ----------------------------------------------------------------


def looks_like_header(cells: Column) -> Column:
    """Two or more short labels, none empty and none a number."""
    clean = F.transform(cells, T.clean_cell)
    label = lambda c: ~F.lower(c).isin(*T.NULLISH) & ~T.is_number(c) & (F.length(c) <= 40)
    return (F.size(clean) >= 2) & F.forall(clean, label)


def unique_columns(names: Column) -> Column:
    """Blank names become col_N; a name that occurs again gets its count, whatever its case."""
    named = F.transform(names, lambda n, i: F.coalesce(F.nullif(T.clean_cell(n), F.lit("")), F.concat(F.lit("col_"), (i + 1).cast("string"))))
    lowered = F.transform(named, F.lower)

    def numbered(name: Column, i: Column) -> Column:
        times = F.size(F.filter(F.slice(lowered, 1, i + 1), lambda x: x == F.lower(name)))
        return F.when(times == 1, name).otherwise(F.concat_ws("_", name, times.cast("string")))

    return F.transform(named, numbered)


def split_table(tables: DataFrame, raw: str = "raw_rows") -> DataFrame:
    """Adds title, band, columns, has_header, header_row and rows, read off a raw grid; empty grids go.

    A first row with one filled cell of several is a title band; a single column of three rows or
    more has its title in the first.
    """
    text = F.transform(raw, lambda r: F.transform(r, T.clean_cell))
    filled = F.filter(text, lambda r: F.exists(r, lambda c: c != ""))
    t = tables.withColumn("__rows", filled).where(F.size("__rows") > 0)
    t = t.withColumn("__n", F.array_max(F.transform("__rows", F.size)))
    t = t.withColumn("__rows", F.transform("__rows", lambda r: F.concat(r, F.array_repeat(F.lit(""), F.col("__n") - F.size(r)))))
    first = F.element_at("__rows", 1)
    band = (F.col("__n") > 1) & (F.size("__rows") >= 2) & (F.size(F.filter(first, lambda c: c != "")) == 1)
    single = (F.col("__n") == 1) & (F.size("__rows") >= 3)
    t = t.withColumns({"band": band, "title": F.when(band | single, F.element_at(F.filter(first, lambda c: c != ""), 1)), "__rows": F.when(band | single, F.slice("__rows", 2, F.size("__rows"))).otherwise(F.col("__rows"))})
    first = F.element_at("__rows", 1)
    t = t.withColumn("has_header", (F.col("__n") > 1) & (F.size("__rows") >= 2) & looks_like_header(first))
    plain = F.transform(F.sequence(F.lit(1), F.col("__n")), lambda i: F.concat(F.lit("col_"), i.cast("string")))
    return t.withColumns(
        {
            "header_row": F.when(F.col("has_header"), first),
            "columns": F.when(F.col("has_header"), unique_columns(first)).otherwise(plain),
            "rows": F.when(F.col("has_header"), F.slice("__rows", 2, F.size("__rows"))).otherwise(F.col("__rows")),
        }
    ).drop("__rows", "__n")


def render_row(row: Column) -> Column:
    return F.array_join(row, " | ", "")


def header_lines(title: Column, section: Column, pages: Column, columns: Column, has_header: Column, sheet: Column) -> Column:
    """The lines that say what a table is; ``pages`` is null or empty where they mean nothing."""
    other = section.isNotNull() & (section != "") & (section != title) & (sheet.isNull() | (section != sheet))
    span = F.when(F.size(pages) > 1, F.concat_ws("-", F.element_at(pages, 1).cast("string"), F.element_at(pages, -1).cast("string"))).otherwise(F.get(pages, F.lit(0)).cast("string"))
    place = F.when(F.nullif(sheet, F.lit("")).isNotNull(), F.concat(F.lit("Sheet: "), sheet)).when(F.size(pages) > 0, F.concat(F.lit("Pages: "), span))
    return F.concat_ws("\n", F.concat(F.lit("Table: "), title), F.when(other, F.concat(F.lit("Section: "), section)), place, F.when(has_header, F.concat(F.lit("Columns: "), render_row(columns))))


def table_text(header: Column, rows: Column) -> Column:
    return F.concat_ws("\n", header, F.nullif(F.array_join(F.transform(rows, render_row), "\n"), F.lit("")))


# ---- fields ---------------------------------------------------------------


def _assign(names: list[str], aliases: dict[str, tuple[str, ...]]) -> dict[str, int]:
    """Each field in turn takes the free column that its most preferred alias names."""
    free = {}
    for place, name in enumerate(names):
        free.setdefault(name, []).append(place)
    taken = {}
    for field, options in aliases.items():
        name = next((o for o in options if free.get(o)), None)
        if name is not None:
            taken[field] = free[name].pop(0)
    return taken


def match_columns(tables: DataFrame, aliases: dict[str, tuple[str, ...]], name: str) -> DataFrame:
    """Adds ``name``, a map of field to column place. A batch works it out once for each header."""

    @F.pandas_udf("map<string,int>")
    def assigned(headers: pd.Series) -> pd.Series:
        known: dict[tuple, dict[str, int]] = {}
        keys = [tuple(h) for h in headers]
        for key in set(keys):
            known[key] = _assign(list(key), aliases)
        return pd.Series([known[k] for k in keys], index=headers.index)

    return tables.withColumn(name, assigned(F.transform("columns", T.norm_name)))


def cell(row: Column, mapping: Column, field: str) -> Column:
    """A field's cell; null if it is not mapped or the row is short."""
    return F.get(row, F.try_element_at(mapping, F.lit(field)))


def classify(tables: DataFrame) -> DataFrame:
    """Adds the field maps and ``class``: ancillary_text, secondary, master, monthly, dq, values or generic.

    Columns: element_type, file_type, secondary_sheet, has_header, columns, rows, text.
    """
    t = match_columns(tables, MASTER_ALIASES, "master")
    t = match_columns(t, MONTHLY_ALIASES, "monthly")
    t = match_columns(t, DQ_ALIASES, "dq")
    has = lambda m, *fields: reduce(lambda a, b: a & b, (F.map_contains_key(m, f) for f in fields))
    known = F.size(F.array_intersect(F.map_keys("master"), F.array(*map(F.lit, IDENTITY))))
    record = has("master", "record_id", "date_raw", "status") | ((F.size("master") >= 5) & (has("master", "record_id") | has("master", "date_raw"))) | (known >= 4)
    monthly = has("monthly", "month", "requests", "resolved") & (F.size("monthly") >= 5)
    dq = has("dq", "flag_id", "description") & (F.size("dq") >= 3)
    sheet = F.coalesce(F.col("file_type").isin("xlsx", "xlsm"), F.lit(False))
    values = (F.size("columns") == 1) & is_value_group(F.col("rows"))
    return t.withColumn(
        "class",
        F.when(sheet & (F.col("element_type") == "text"), "ancillary_text").when(sheet & F.coalesce("secondary_sheet", F.lit(False)), "secondary").when(F.col("has_header") & record, "master").when(F.col("has_header") & monthly, "monthly").when(F.col("has_header") & dq, "dq").when(values, "values").otherwise("generic"),
    )


def master_records(tables: DataFrame) -> DataFrame:
    """A typed record for each row of tables of class master, with flags; duplicates count within a table."""
    r = tables.where(F.col("class") == "master").select("*", F.posexplode("rows").alias("row_no", "row"))
    raw = lambda f: cell(F.col("row"), F.col("master"), f)
    text = lambda f: T.text_or_null(raw(f))
    day = T.parse_date(text("date_raw"))
    rest = F.map_from_entries(F.filter(F.transform("headers", lambda h, i: F.when(~F.array_contains(F.map_values("master"), i) & (F.coalesce(F.get(F.col("row"), i), F.lit("")) != ""), F.struct(h.alias("key"), F.get(F.col("row"), i).alias("value")))), lambda e: e.isNotNull()))
    derived = {
        "date_iso": day["iso"], "location": F.coalesce(text("location"), text("entity_site")), "source_fields": rest, "source_file": F.coalesce("file_name", "source"), "source_pages": F.coalesce("pages", F.array(F.col("page"))),
        "sheet_name": F.col("sheet_name"), "block_range": F.col("block_range"),
    }
    fields = [derived[f].alias(f) if f in derived else (T.to_number(raw(f)) if f in NUMBERS else text(f)).alias(f) for f in MASTER if f != "flags"]
    whole = [T.number_is_int(raw(f)).alias(f"{f}_is_int") for f in NUMBERS]
    again = F.coalesce(F.count(F.lit(1)).over(Window.partitionBy("doc_id", "table_id", "record_id")) > 1, F.lit(False)) & F.col("record_id").isNotNull()
    out = r.select("doc_id", "table_id", "row_no", *fields, *whole, day["flag"].alias("date_flag"))
    flags = F.array_compact(F.array(F.col("date_flag"), F.when(F.col("owner").isNull(), "missing_owner"), F.when(F.lower("notes").contains("duplicate"), "possible_duplicate"), F.when(again, "duplicate_id")))
    return out.withColumn("flags", flags).drop("date_flag")


def monthly_performance(tables: DataFrame) -> DataFrame:
    r = tables.where(F.col("class") == "monthly").select("*", F.posexplode("rows").alias("row_no", "row"))
    raw = lambda f: cell(F.col("row"), F.col("monthly"), f)
    numbers = [T.to_number(raw(f)).alias(f) for f in ("requests", "resolved", "avg_hrs", "p95_hrs", "csat", "variance_pct")]
    comment = T.text_or_null(raw("comment"))
    gap = F.array_compact(F.array(F.when(F.lower(comment).contains("data gap"), "data_gap")))
    return r.select("doc_id", "table_id", "row_no", T.text_or_null(raw("month")).alias("month"), *numbers, comment.alias("comment"), gap.alias("flags"))


def quality_flags(tables: DataFrame) -> DataFrame:
    r = tables.where(F.col("class") == "dq").select("*", F.posexplode("rows").alias("row_no", "row"))
    return r.select("doc_id", "table_id", "row_no", *[T.text_or_null(cell(F.col("row"), F.col("dq"), f)).alias(f) for f in DQ_ALIASES])


_VALUE = r"(?U)^\s*(.+?)\s*[:=]\s*(.+?)\s*$"


def _value_lines(rows: Column) -> Column:
    return F.filter(F.transform(rows, lambda r: F.get(r, F.lit(0))), lambda v: v.isNotNull() & (v != ""))


def is_value_group(rows: Column) -> Column:
    """Whether every filled row is ``label: value`` or ``label = value``."""
    lines = _value_lines(rows)
    return (F.size(lines) > 0) & F.forall(lines, lambda v: v.rlike(_VALUE))


def value_groups(tables: DataFrame) -> DataFrame:
    item = lambda v: F.struct(F.regexp_extract(v, _VALUE, 1).alias("label"), F.regexp_extract(v, _VALUE, 2).alias("value_raw"), T.to_number(F.regexp_extract(v, _VALUE, 2)).alias("value_number"), F.when(v.rlike(r"%\s*$"), "%").alias("unit"))
    return tables.where(F.col("class") == "values").select("doc_id", "table_id", "title", "section", "pages", F.transform(_value_lines(F.col("rows")), item).alias("items"))


def generic_tables(tables: DataFrame) -> DataFrame:
    """Tables of no class, and those of secondary sheets, losslessly: each row a map by column."""
    name = lambda i: F.coalesce(F.get(F.col("columns"), i), F.concat(F.lit("col_"), (i + 1).cast("string")))
    as_map = lambda r: F.map_from_entries(F.transform(r, lambda v, i: F.struct(name(i).alias("key"), v.alias("value"))))
    return tables.where(F.col("class").isin("generic", "secondary")).select("doc_id", "table_id", "title", "section", "pages", "columns", "has_header", F.size("rows").alias("n_rows"), F.transform("rows", as_map).alias("rows"))


def ancillary_tables(tables: DataFrame) -> DataFrame:
    """What is kept as it stands: untyped tables, sheet texts, and the columns that a typed table left over."""
    title = F.coalesce(F.nullif("title", F.lit("")), F.nullif("heading", F.lit("")), F.lit("Untitled table"))
    page = F.coalesce(F.get("pages", F.lit(0)), F.col("page")).alias("page_number")
    tail = ["file_name", "sheet_name", "sheet_index", "block_range"]
    plain = tables.where(F.col("class").isin("generic", "secondary")).select("doc_id", "table_id", title.alias("table_name"), page, F.coalesce("headers", "columns").alias("headers"), "rows", *tail)
    lines = F.filter(F.split("text", "\n"), lambda x: T.strip(x) != "")
    sheet_text = tables.where(F.col("class") == "ancillary_text").where(F.size(lines) > 0).select("doc_id", "table_id", F.coalesce(F.nullif("title", F.lit("")), "block_range", F.lit("Spreadsheet text block")).alias("table_name"), F.col("page").alias("page_number"), F.array(F.lit("Text")).alias("headers"), F.transform(lines, lambda x: F.array(x)).alias("rows"), *tail)
    rest = tables.where(F.col("class") == "master").withColumn("__h", F.coalesce("headers", "columns"))
    places = F.filter(F.sequence(F.lit(0), F.size("__h") - 1), lambda i: ~F.array_contains(F.map_values("master"), i))
    rest = rest.withColumn("__places", places).withColumn("__rows", F.filter(F.transform("rows", lambda r: F.transform(F.col("__places"), lambda i: F.coalesce(F.get(r, i), F.lit("")))), lambda r: F.exists(r, lambda c: c != "")))
    extra = rest.where((F.size("__places") > 0) & (F.size("__rows") > 0)).select("doc_id", "table_id", F.concat(title, F.lit(" - additional columns")).alias("table_name"), page, F.transform("__places", lambda i: F.get("__h", i)).alias("headers"), F.col("__rows").alias("rows"), *tail)
    return plain.unionByName(sheet_text).unionByName(extra)


# ---- stitching ------------------------------------------------------------

_MARGIN, _SHIFT = 70, 20


def _continues(last: dict, new: dict) -> bool:
    """Whether a table goes on where the last one of the page before ended."""
    if len(last["columns"]) != len(new["columns"]) or new["pages"][0] - last["pages"][-1] != 1:
        return False
    if last["x1"] and new["x1"] and max(abs(last["x0"] - new["x0"]), abs(last["x1"] - new["x1"])) > _SHIFT:
        return False
    named = new["title"] is not None or new["heading"] is not None
    if last["has_header"] and new["has_header"] and last["names"] == new["names"]:
        return not named or "continu" in f"{new['title'] or ''} {new['heading'] or ''}".lower()
    if named or not last["page_height"] or (new["has_header"] and last["has_header"]):
        return False
    return last["bottom"] >= last["page_height"] - _MARGIN and new["top"] <= _MARGIN


def stitched(group: list[dict]) -> list[dict]:
    """One document's body tables in order, those that page breaks cut put together (in the first's mapping)."""
    done: list[dict] = []
    for new in group:
        new |= {"merged_parts": 1, "part_titles": []}
        for side in ("x0", "x1", "top", "bottom", "page_height"):
            new[side] = new[side] or 0.0
        last = done[-1] if done else None
        if last is None or not _continues(last, new):
            done.append(new)
            continue
        if new["has_header"] and not last["has_header"] and new["header_row"] is not None:
            last["rows"].append(list(new["header_row"]))  # it was a row of data
        last["rows"] += new["rows"]
        last["pages"] = sorted({*last["pages"], *new["pages"]})
        last["bottom"] = new["bottom"]
        last["merged_parts"] += 1
        if new["title"] or new["heading"]:
            last["part_titles"].append(new["title"] or new["heading"])
    return done


def stitch(tables: DataFrame) -> DataFrame:
    """Joins tables that page breaks cut, document by document, in order of element_no.

    Whether a table goes on depends on what was already joined, so this is a fold; a group is
    one document's body tables. Columns: doc_id, element_no, kind, columns, has_header,
    header_row, rows, title, heading, pages, x0, x1, top, bottom, page_height; merged_parts and
    part_titles are added.
    """
    schema = tables.withColumns({"merged_parts": F.lit(1), "part_titles": F.array().cast("array<string>")}).schema
    plain = tables.where("kind <> 'body'").withColumns({"merged_parts": F.lit(1), "part_titles": F.array().cast("array<string>")})
    body = tables.where("kind = 'body'").withColumn("names", F.transform("columns", T.norm_name))
    joined = fold_groups(body, ["doc_id"], ["element_no"], schema, lambda group: [{k: v for k, v in t.items() if k != "names"} for t in stitched(group)])
    return joined.unionByName(plain)
