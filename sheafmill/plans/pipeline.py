"""From files to typed results: one lazy pipeline of DataFrames; failures are rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, fields

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import chunk, clean, extract, index, retrieve
from ..operators import tables as tab
from ..schemas import INFO
from ..sinks import cache
from ..sources import files
from ..storage import settled

Model = Callable[[str, str], dict]

# What is looked for in each section, in several phrasings.
SECTIONS = {
    "document_info": {
        "queries": (
            "document title, type, revision or version and the period it covers",
            "name of the person or organization, department and job designation",
            "contact email address and phone number",
            "document date, prepared by, issued on",
        ),
        "k": 6, "first_pages": 1, "pattern": None, "neighbours": 0,
    },
    "field_notes": {
        "queries": (
            "field notes raw observations dated entries",
            "note says discrepancy mismatch duplicate unclear recheck not copied",
            "remarks comments issues observed log",
        ),
        "k": 4, "first_pages": 0, "pattern": "field notes|observations|remarks|log|notes", "neighbours": 1,
    },
}
TEXTS = {"element_type": ["text", "ocr_text"]}
NO_CONTEXT = "document_info: no context retrieved"


@dataclass(frozen=True)
class Result:
    """Tables of an extraction, each by doc_id."""

    elements: DataFrame
    chunks: DataFrame
    contexts: DataFrame
    tables: DataFrame
    records: DataFrame
    monthly: DataFrame
    quality_flags: DataFrame
    value_groups: DataFrame
    ancillary: DataFrame
    info: DataFrame
    notes: DataFrame
    report: DataFrame
    transcripts: DataFrame
    warnings: DataFrame
    errors: DataFrame


def contexts(chunks: DataFrame, sections: dict = SECTIONS, where: Column | dict | None = TEXTS, cap: int = 12_000, attempt: int = 0) -> DataFrame:
    """(doc_id, kind, context, chars, chunks, picked): what each section of each document is read from, and which chunks these are.

    Every document is searched within itself: its number is a part of the query's, so statistics
    and ranks are by document. A later attempt looks at six more chunks.
    """
    docs = chunks.select("doc_id").distinct()
    out = None
    for kind, spec in sections.items():
        asked = chunks.sparkSession.createDataFrame([(i, q) for i, q in enumerate(spec["queries"])], "q int, query string")
        picked = search_each(chunks, docs, asked, where, spec["k"] + 6 * attempt)
        if spec["pattern"]:
            picked = picked.unionByName(retrieve.by_section(chunks, spec["pattern"], where).select("doc_id", "chunk_index"))
        if spec["first_pages"]:
            picked = picked.unionByName(retrieve.first_pages(chunks, spec["first_pages"], where).select("doc_id", "chunk_index"))
        if spec["neighbours"]:
            near = retrieve.neighbours(picked, chunks, spec["neighbours"]).where(retrieve.mask(where))
            picked = picked.unionByName(near.select("doc_id", "chunk_index"))
        rows = chunks.join(picked.distinct(), ["doc_id", "chunk_index"], "left_semi").withColumn("body", T.without_preamble(F.col("text")))
        part = retrieve.context(rows, cap).withColumn("kind", F.lit(kind))
        out = part if out is None else out.unionByName(part)
    return out


def search_each(chunks: DataFrame, docs: DataFrame, asked: DataFrame, where: Column | dict | None, k: int) -> DataFrame:
    """(doc_id, chunk_index) of the best chunks of each document, fused over all phrasings and rankers.

    Hashed vectors rank every chunk, BM25 and identifiers those with a score. Terms, lengths and
    hits are those of the document, so it is the same as an index for each; a mask changes no score.
    """
    by_doc = Window.partitionBy("doc_id")
    keyed = chunks.select("doc_id", "chunk_index", "text", F.struct("doc_id", "chunk_index").alias("chunk"))
    bags = keyed.select("doc_id", "chunk_index", T.tokens(F.col("text")).alias("ts")).withColumn("size", F.size("ts"))
    bags = bags.withColumns({"n": F.count(F.lit(1)).over(by_doc), "mean": F.avg("size").over(by_doc)})
    tf = bags.select("doc_id", "chunk_index", "size", "n", "mean", F.explode("ts").alias("term")).groupBy("doc_id", "chunk_index", "size", "n", "mean", "term").agg(F.count(F.lit(1)).alias("tf"))
    tf = tf.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("doc_id", "term")))
    terms = asked.select("q", F.explode(F.array_distinct(T.tokens(F.col("query")))).alias("term"))
    weight = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5)) * F.col("tf") * 2.5 / (F.col("tf") + 1.5 * (0.25 + 0.75 * F.col("size") / F.greatest("mean", F.lit(1.0))))
    lexical = tf.join(terms, "term").groupBy("doc_id", "q", "chunk_index").agg(F.sum(weight).alias("score"))

    vectors = index.hash_vectors(keyed, "chunk")
    wanted = index.hash_vectors(asked.select("q", F.col("query").alias("text")), "q").withColumnRenamed("weight", "w")
    near = vectors.join(wanted, "bucket").groupBy("chunk", "q").agg(F.sum(F.col("weight") * F.col("w")).alias("near")).select("chunk.doc_id", "chunk.chunk_index", "q", "near")
    numbers = asked.agg(F.collect_list("q").alias("qs")).scalar()
    every = keyed.select("doc_id", "chunk_index", F.explode(numbers).alias("q"))
    dense = every.join(near, ["doc_id", "chunk_index", "q"], "left").select("doc_id", "q", "chunk_index", F.coalesce("near", F.lit(0.0)).alias("score"))

    names = asked.select("q", F.explode(F.transform(index.identifiers(F.col("query")), lambda t: F.lower(t))).alias("token"))
    tokens = names.agg(F.collect_set("token").alias("ts")).scalar()
    hits = keyed.select("doc_id", "chunk_index", "text", F.count(F.lit(1)).over(by_doc).alias("n"), tokens.alias("ts")).select("doc_id", "chunk_index", "n", F.explode(F.filter("ts", lambda t: index.has_identifier(F.col("text"), t))).alias("token"))
    hits = hits.withColumn("weight", F.log(1 + F.col("n") / (1 + F.count(F.lit(1)).over(Window.partitionBy("doc_id", "token")))))
    exact = hits.join(names, "token").groupBy("doc_id", "q", "chunk_index").agg(F.sum("weight").alias("score"))

    rank = F.row_number().over(Window.partitionBy("doc_id", "q").orderBy(F.col("score").desc(), "chunk_index"))
    votes = None
    for scores, floor in ((dense, -1.0), (lexical, 0.0), (exact, 0.0)):
        scores = scores.withColumn("score", F.round("score", 9))
        if where is not None:
            scores = scores.join(chunks.where(retrieve.mask(where)).select("doc_id", "chunk_index"), ["doc_id", "chunk_index"], "left_semi")
        part = scores.where(F.col("score") > floor).withColumn("rank", rank).where(F.col("rank") <= retrieve.CANDIDATES).select("doc_id", "chunk_index", "rank")
        votes = part if votes is None else votes.unionByName(part)
    fused = votes.groupBy("doc_id", "chunk_index").agg(F.round(F.sum(1 / (retrieve.RRF + F.col("rank"))), 12).alias("fused"))
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.col("fused").desc(), "chunk_index"))
    return fused.withColumn("place", place).where(F.col("place") <= k).join(docs, "doc_id", "left_semi").select("doc_id", "chunk_index")


def extract_all(elements: DataFrame, model: Model | None = None, model_name: str = "none", budget: int | None = None, attempt: int = 0, kept: str | None = None, tokenizer: str | None = None) -> Result:
    """Everything that can be read from elements. Without a model only tables and noted lines are typed.

    ``kept`` is a folder of answers by their requests: what is there isn't asked again, and new
    answers go there. Tokens are counted by a ``tokenizer``'s file, if one is given.
    """
    good, errors = files.good(elements), files.errors(elements)
    cleaned = settled(clean.clean_elements(good), "elements")
    chunks = settled(chunk.chunk_elements(cleaned, budget or chunk.default_budget(), tokenizer), "chunks")
    found = settled(contexts(chunks, attempt=attempt), "contexts")
    rows = cleaned.withColumn("page", F.coalesce("page", F.lit(1)))
    typed = settled(tab.classify(rows.where("element_type = 'table'").unionByName(rows.where("element_type = 'text' and file_type in ('xlsx', 'xlsm')").withColumns({"columns": F.coalesce("columns", F.array().cast("array<string>")), "rows": F.coalesce("rows", F.array().cast("array<array<string>>")), "has_header": F.coalesce("has_header", F.lit(False))}))), "typed")
    records = settled(extract.promote_records(tab.master_records(typed)), "records")
    sources = cleaned.withColumn("body", F.when(F.col("element_type") == "table", F.array_join(F.transform("rows", tab.render_row), "\n")).otherwise(F.col("text"))).groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("element_no", "body"))), lambda x: x["body"]), "\n").alias("source_text"))
    sources = settled(sources, "sources")
    noted = found.where("kind = 'field_notes'").select("doc_id", F.col("context").alias("text"))
    notes = extract.pipe_notes(noted)
    empty = [F.lit(None).cast("string").alias(f) for f in INFO]
    info = sources.select("doc_id", *empty)
    full = found.where(T.strip(F.col("context")) != "")
    missing = sources.select("doc_id").join(full.where("kind = 'document_info'"), "doc_id", "left_anti")
    warnings = extract.row_count_warnings(typed, records).unionByName(missing.select("doc_id", F.lit(NO_CONTEXT).alias("warning")))
    if model is not None:
        # The model is asked for notes only where no lines are noted.
        open_notes = full.where("kind = 'field_notes'").join(notes.select("doc_id").distinct(), "doc_id", "left_anti")
        asked = full.where("kind = 'document_info'").select("doc_id", "kind", "context").unionByName(open_notes.select("doc_id", "kind", "context"))
        known = cache.get(elements.sparkSession, kept, "answers", "key string, answer map<string,string>")
        said = settled(extract.ask_model(asked, model, model_name, None if kept is None else known), "answers")
        cache.put(said.where("error is null and answer is not null").select("key", "answer"), kept, "answers")
        info = sources.select("doc_id").join(said.where("kind = 'document_info'"), "doc_id", "left").select("doc_id", *[F.try_element_at("answer", F.lit(f)).alias(f) for f in INFO])
        more, unread = extract.said_notes(said.where("kind = 'field_notes'"))
        notes = notes.unionByName(more)
        warnings = warnings.unionByName(said.where("error is not null").select("doc_id", F.col("error").alias("warning"))).unionByName(unread)
    notes = extract.verified(notes, sources)
    info = extract.ground_info(info, sources)
    warnings = warnings.unionByName(info.select("doc_id", F.explode("warnings").alias("warning"))).unionByName(notes.where("not verified").select("doc_id", F.concat(F.lit("field note not found verbatim in source: '"), F.substring("text", 1, 60), F.lit("'")).alias("warning")))
    monthly, dq, values, rest = tab.monthly_performance(typed), tab.quality_flags(typed), tab.value_groups(typed), tab.ancillary_tables(typed)
    report = extract.report(typed, records, {"monthly_performance": monthly, "value_groups": values, "data_quality_flags": dq, "field_notes": notes, "ancillary_tables": rest})
    return Result(cleaned, chunks, found, typed, records, monthly, dq, values, rest, info.drop("warnings"), notes, report, extract.transcripts(cleaned), warnings, errors)


def needs_retry(result: Result) -> DataFrame:
    """Documents whose extraction failed, or found no context, for a reason that looking again may mend.

    That is not so for a quota, nor for a missing context of a document without any text to search.
    """
    w = result.warnings
    stuck = w.where(F.col("warning").contains("RESOURCE_EXHAUSTED") | F.col("warning").contains("quota")).select("doc_id")
    searched = result.chunks.where(retrieve.mask(TEXTS)).select("doc_id").distinct()
    failed = w.where(F.col("warning").contains("extraction failed")).select("doc_id")
    missed = w.where(F.col("warning").contains("no context")).select("doc_id").join(searched, "doc_id", "left_semi")
    return failed.unionByName(missed).distinct().join(stuck, "doc_id", "left_anti")


def extract_with_retries(elements: DataFrame, model: Model | None = None, model_name: str = "none", budget: int | None = None, attempts: int = 2, kept: str | None = None, tokenizer: str | None = None) -> Result:
    """:func:`extract_all`; documents that need it are looked at again, with more chunks in each section.

    What a later attempt finds of a document takes the place of all that was found of it before.
    """
    result = extract_all(elements, model, model_name, budget, 0, kept, tokenizer)
    for attempt in range(1, attempts):
        again = settled(needs_retry(result), "again")
        if again.isEmpty():
            break
        part = extract_all(elements.join(again, "doc_id", "left_semi"), model, model_name, budget, attempt, kept, tokenizer)
        merged = {}
        for field in fields(Result):
            old, new = getattr(result, field.name), getattr(part, field.name)
            merged[field.name] = old if field.name == "errors" else settled(old.join(again, "doc_id", "left_anti").unionByName(new), field.name)
        result = Result(**merged)
    return result


def answer(chunks: DataFrame, questions: DataFrame, model: Callable[[str, str], str], k: int = 8) -> DataFrame:
    """(query_id, query, prompt, answer, cited): questions on all chunks, answered from what is found, with citations."""
    hits = retrieve.hybrid(chunks, questions.withColumn("need_id", F.col("query_id")), k=k)
    cited = hits.join(chunks, "chunk_id").withColumn("said", F.concat(T.citation(F.col("title"), F.col("section"), F.col("pages")), F.lit("\n"), "text"))
    rows = cited.groupBy("need_id").agg(F.array_sort(F.collect_list(F.struct("place", "said", "chunk_id"))).alias("c"))
    prompts = questions.join(rows, questions["query_id"] == rows["need_id"], "left").select("query_id", "query", F.array_join(F.transform(F.coalesce("c", F.array()), lambda x: x["said"]), "\n\n").alias("prompt"), F.transform("c", lambda x: x["chunk_id"]).alias("cited"))

    @F.pandas_udf("string")
    def ask(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for asked, given in parts:
            yield pd.Series([model(q, p) for q, p in zip(asked, given, strict=True)])

    return prompts.withColumn("answer", ask("query", "prompt"))
