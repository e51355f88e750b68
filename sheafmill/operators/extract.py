"""Extraction of typed results: notes, promoted fields, grounding, and a document's report.

The model behind document info and notes is a plug-in: any function from (kind, context) to a
mapping. It is only asked where a pattern doesn't answer, results are kept by the content they
came from, and what it says is checked against the source.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..schemas import INFO

#: Fields of document info that must stand in the source.
GROUNDED = ("name", "organization", "department", "designation", "email", "phone", "title", "revision", "date", "date_range")

# Names of attributes that are promoted to typed fields.
PROMOTED = {
    "id": "record_id", "record id": "record_id", "record": "record_id", "ticket id": "record_id", "ref": "record_id",
    "name": "name", "full name": "name", "employee name": "name",
    "department": "department", "dept": "department", "business unit": "department",
    "location": "location", "office": "location", "city": "location",
    "date": "date_raw", "record date": "date_raw", "created date": "date_raw",
    "status": "status", "record status": "status",
    "amount": "amount", "total": "amount", "value": "amount",
    "priority": "priority", "urgency": "priority",
}


def pairs_of(source: Column) -> Column:
    """``k=v; k=v`` as an array of (key, value): split at the first ``=``, the last of equal keys holds."""
    split = F.transform(F.split(source, ";"), lambda p: F.struct(T.strip(F.substring_index(p, "=", 1)).alias("key"), T.strip(F.substr(p, F.instr(p, "=") + 1)).alias("value"), F.contains(p, F.lit("=")).alias("is_pair")))
    named = F.filter(split, lambda p: p["is_pair"] & (p["key"] != ""))
    keys = F.transform(named, lambda p: p["key"])
    last = F.filter(named, lambda p, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), p["key"]))
    return F.transform(last, lambda p: F.struct(p["key"].alias("key"), p["value"].alias("value")))


def promote(records: DataFrame, source: str = "source_fields") -> DataFrame:
    """Fills empty typed fields from the attribute pairs of ``source`` (an array of key, value); the rest stays there.

    A promoted amount is cleaned like any number. Location and site stand in for each other.
    """
    names = F.create_map(*[F.lit(x) for kv in PROMOTED.items() for x in kv])
    target = lambda p: F.try_element_at(names, T.norm_name(p["key"]))

    def first(field: str) -> Column:
        return F.get(F.filter(source, lambda p: F.coalesce(target(p) == field, F.lit(False)) & (p["value"] != "")), F.lit(0))["value"]

    out = records
    for field in sorted(set(PROMOTED.values())):
        found = first(field)
        if f"{field}_is_int" in records.columns:
            out = out.withColumn(f"{field}_is_int", F.coalesce(f"{field}_is_int", F.when(F.col(field).isNull(), T.number_is_int(found))))
        found = T.to_number(found) if field == "amount" else found
        have = F.col(field) if field == "amount" else F.nullif(F.col(field), F.lit(""))
        out = out.withColumn(field, F.coalesce(have, found))
    site = F.coalesce(F.nullif("entity_site", F.lit("")), "location")
    return out.withColumns({"entity_site": site, source: F.filter(source, lambda p: target(p).isNull())})


def promote_records(records: DataFrame) -> DataFrame:
    """:func:`promote` of records whose ``source_fields`` are a map."""
    as_pairs = F.transform(F.map_entries("source_fields"), lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))
    out = promote(records.withColumn("source_fields", F.coalesce(as_pairs, F.array().cast("array<struct<key:string,value:string>>"))))
    return out.withColumn("source_fields", F.map_from_entries("source_fields")).select(*records.columns)


def transcripts(elements: DataFrame) -> DataFrame:
    """(doc_id, row_no, page_number, text): what OCR read of each document, in order."""
    order = Window.partitionBy("doc_id").orderBy("element_no")
    return elements.where("element_type = 'ocr_text'").select("doc_id", (F.row_number().over(order) - 1).alias("row_no"), F.col("page").alias("page_number"), "text")


def pipe_notes(texts: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Notes written as ``date | area | text`` lines, of texts where at least half the lines (two or more) are."""
    lines = F.filter(F.transform(F.split(text, "\n"), T.strip), lambda x: x != "")
    parts = F.transform(lines, lambda x: F.transform(F.split(x, r" \| "), T.strip))
    notes = F.filter(parts, lambda p: F.size(p) >= 3)
    shaped = texts.select(key, notes.alias("notes"), F.size(lines).alias("n")).where(F.size("notes") >= F.greatest(F.lit(2), F.floor(F.col("n") * 0.5)))
    exploded = shaped.select(key, F.posexplode("notes").alias("note_no", "p"))
    return exploded.select(key, "note_no", F.get("p", F.lit(0)).alias("date_raw"), F.get("p", F.lit(1)).alias("area"), F.array_join(F.slice("p", 3, F.size("p")), " | ").alias("text"))


def said_notes(answers: DataFrame, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Notes of a model's answers, in the columns of :func:`pipe_notes`, and (key, warning) of answers that can't be read.

    An answer's ``notes`` is a list of mappings with date_raw, area and text; a note without text
    fails the answer, and no ``notes`` are none.
    """
    given = F.try_element_at("answer", F.lit("notes"))
    read = answers.where("error is null").select(key, given.alias("given"), F.from_json(given, "array<struct<date_raw:string,area:string,text:string>>").alias("read"))
    bad = F.col("given").isNotNull() & F.coalesce(F.exists("read", lambda n: n["text"].isNull()), F.lit(True))
    notes = read.where(~bad).select(key, F.posexplode("read").alias("note_no", "p")).select(key, "note_no", "p.date_raw", "p.area", "p.text")
    return notes, read.where(bad).select(key, F.lit("field_notes extraction failed: the answer's notes can't be read").alias("warning"))


def verified(notes: DataFrame, sources: DataFrame, key: str = "doc_id") -> DataFrame:
    """Notes with ``verified``: whether their text stands in the document's source."""
    return notes.join(sources.select(key, F.col("source_text")), key, "left").withColumn("verified", F.coalesce(T.grounded(F.col("text"), F.coalesce("source_text", F.lit(""))), F.lit(False))).drop("source_text")


def ground_info(info: DataFrame, sources: DataFrame, key: str = "doc_id") -> DataFrame:
    """Document info whose ungrounded values are null, with a warning for each."""
    joined = info.join(sources.select(key, "source_text"), key, "left")
    ok = {f: T.grounded(F.col(f), F.coalesce("source_text", F.lit(""))) for f in GROUNDED}
    warnings = F.array_compact(F.array(*[F.when(~ok[f], F.concat(F.lit(f"document_info.{f} dropped: '"), F.col(f), F.lit("' not found in source"))) for f in GROUNDED]))
    fields = [F.when(ok[f], F.col(f)).alias(f) if f in ok else F.col(f) for f in INFO]
    return joined.withColumn("warnings", warnings).select(key, *fields, "warnings")


def report(tables: DataFrame, records: DataFrame, others: dict[str, DataFrame]) -> DataFrame:
    """Counts by document: tables found and stitched, results of each kind, duplicate ids, ambiguous dates."""
    flag = lambda f: F.array_contains("flags", f)
    out = tables.groupBy("doc_id").agg(F.count_if(F.col("element_type") == "table").alias("tables_found"), F.count_if(F.coalesce("merged_parts", F.lit(1)) > 1).alias("stitched_tables"))
    counted = records.groupBy("doc_id").agg(F.count(F.lit(1)).alias("master_records"), F.array_sort(F.collect_set(F.when(flag("duplicate_id"), F.col("record_id")))).alias("duplicate_ids"), F.count_if(flag("date_ambiguous")).alias("ambiguous_dates"))
    out = out.join(counted, "doc_id", "left")
    for name, rows in others.items():
        out = out.join(rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias(name)), "doc_id", "left")
    return out.na.fill(0).withColumn("duplicate_ids", F.coalesce("duplicate_ids", F.array().cast("array<string>")))


def row_count_warnings(tables: DataFrame, records: DataFrame) -> DataFrame:
    """(doc_id, warning) where a document's record tables hold other than the rows that were parsed."""
    expected = tables.join(records.select("doc_id", "table_id").distinct(), ["doc_id", "table_id"], "left_semi").groupBy("doc_id").agg(F.sum("n_rows").alias("expected"))
    parsed = records.groupBy("doc_id").agg(F.count(F.lit(1)).alias("parsed"))
    both = parsed.join(expected, "doc_id").where((F.col("expected") > 0) & (F.col("parsed") != F.col("expected")))
    return both.select("doc_id", F.format_string("master_records: parsed %d rows but tables hold %d", "parsed", "expected").alias("warning"))


# ---- the model --------------------------------------------------------------


def is_quota_error(error: Exception) -> bool:
    said = f"{getattr(error, 'code', '')} {error}".upper()
    status = getattr(error, "status_code", None) or getattr(getattr(error, "response", None), "status_code", None)
    return status == 429 or "RESOURCE_EXHAUSTED" in said or "429" in said


def retried(call: Callable[[], dict], attempts: int = 3, pause: float = 1.5, sleep: Callable[[float], None] = time.sleep) -> dict:
    """The result of a call that may fail now and then; the last error is raised, and one about a quota at once."""
    for attempt in range(attempts):
        try:
            return call()
        except Exception as error:
            if is_quota_error(error) or attempt + 1 == attempts:
                raise
            sleep(pause * 2**attempt)
    raise ValueError("no attempt was allowed")


def with_fallback(first: Callable[[str, str], dict], second: Callable[[], Callable[[str, str], dict]] | None) -> Callable[[str, str], dict]:
    """A model that asks another one, made when it is needed, where the first has no quota left."""

    def ask(kind: str, context: str) -> dict:
        try:
            return first(kind, context)
        except Exception as error:
            if second is None or not is_quota_error(error):
                raise
            return second()(kind, context)

    return ask


def request_key(kind: Column, context: Column, model: str) -> Column:
    """What a result is kept by: the model's stated name, the kind and the context."""
    return F.sha2(F.to_json(F.struct(F.lit(model).alias("model"), kind.alias("kind"), context.alias("context"))), 256)


def _plain(value) -> str | None:
    return json.dumps(value, ensure_ascii=False) if isinstance(value, (list, dict)) else None if value is None else str(value)


def ask_model(contexts: DataFrame, model: Callable[[str, str], dict], model_name: str, cache: DataFrame | None = None, attempts: int = 3) -> DataFrame:
    """(doc_id, kind, key, answer map, error) for contexts (doc_id, kind, context); equal requests are asked once.

    Values of an answer that are lists or mappings are kept as JSON.

    ``cache`` has (key, answer). An error is a value, so that one document's doesn't stop others;
    after one about a quota a task asks no more.
    """
    keyed = contexts.withColumn("key", request_key(F.col("kind"), F.col("context"), model_name))
    todo = keyed.dropDuplicates(["key"])
    if cache is not None:
        todo = todo.join(cache.select("key"), "key", "left_anti")

    def run(batches):
        out_of_quota = None
        for frame in batches:
            rows = []
            for key, kind, context in zip(frame["key"], frame["kind"], frame["context"], strict=True):
                answer, error = None, None
                if out_of_quota:
                    error = f"{kind} extraction skipped: {out_of_quota}"
                else:
                    try:
                        answer = {k: _plain(v) for k, v in retried(lambda kind=kind, context=context: model(kind, context), attempts).items()}
                    except Exception as failure:
                        error = f"{kind} extraction failed: {failure}"
                        out_of_quota = "LLM quota exhausted" if is_quota_error(failure) else None
                rows.append((key, answer, error))
            yield pd.DataFrame(rows, columns=["key", "answer", "error"])

    answers = todo.select("key", "kind", "context").mapInPandas(run, "key string, answer map<string,string>, error string")
    if cache is not None:
        answers = answers.unionByName(cache.select("key", "answer", F.lit(None).cast("string").alias("error")))
    return keyed.drop("context").join(answers, "key", "left")
