"""Cleaning of text elements: running headers and footers, page numbers, normal forms.

Works on elements (doc_id, element_no, element_type, page, region, file_type, text, ...). Tables
pass untouched.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import text as T

SPREADSHEETS = ("xlsx", "xlsm")


@F.pandas_udf(StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    """Unicode compatibility composition; there is no built-in for it."""
    return texts.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFKC", t))


def lines_of(elements: DataFrame, text: Column | None = None) -> DataFrame:
    """A row for each line: the keys, line_no and line."""
    text = F.col("text") if text is None else text
    return elements.select("doc_id", "element_no", "page", "file_type", F.posexplode(F.split(text, "\n")).alias("line_no", "line"))


def repeated_lines(lines: DataFrame, ratio: float = 0.6) -> DataFrame:
    """(doc_id, signature, pages): lines on at least ``ratio`` of a document's pages, three at least.

    Pairs of signature and page are made distinct before they are counted, so a line that is
    everywhere costs a row for each page.
    """
    pages = lines.groupBy("doc_id").agg(F.count_distinct("page").alias("all_pages"))
    seen = lines.where(T.strip(F.col("line")) != "").select("doc_id", "page", T.line_signature(F.col("line")).alias("signature")).distinct()
    counted = seen.groupBy("doc_id", "signature").agg(F.count(F.lit(1)).alias("pages"))
    least = F.greatest(F.lit(3), F.floor(F.lit(ratio) * F.col("all_pages")))
    return counted.join(pages, "doc_id").where((F.col("all_pages") >= 3) & (F.col("pages") >= least)).select("doc_id", "signature", "pages")


def clean_elements(elements: DataFrame) -> DataFrame:
    """``elements`` cleaned: margins dropped, repeated and page-number lines dropped, text normalised, empties dropped.

    A line's signature is taken after the same normalisation for the count and for the drop.
    """
    is_table = F.col("element_type") == "table"
    tables = elements.where(is_table)
    body = elements.where(~is_table).where(~F.coalesce(F.col("region").isin("header", "footer"), F.lit(False)))
    # Margins count as evidence of repeated lines although they go themselves.
    evidence = elements.where(~is_table).withColumn("text", T.plain_text(nfkc(F.col("text"))))
    lines = lines_of(evidence).withColumn("line", T.clean_line(F.col("line")))
    exempt = F.coalesce(F.col("file_type").isin(*SPREADSHEETS), F.lit(False))
    repeated = repeated_lines(lines).select("doc_id", "signature")
    kept = lines.withColumn("signature", T.line_signature(F.col("line"))).where(exempt | ~T.is_page_number(F.col("line")))
    marked = kept.join(repeated.withColumn("again", F.lit(True)), ["doc_id", "signature"], "left")
    kept = marked.where(exempt | F.col("again").isNull() | (F.col("line") == ""))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n")
    texts = kept.groupBy("doc_id", "element_no").agg(T.strip(F.regexp_replace(joined, "\n{3,}", "\n\n")).alias("text")).where("text <> ''")
    return body.drop("text").join(texts, ["doc_id", "element_no"]).select(*elements.columns).unionByName(tables)


def numbered(rows: DataFrame, by: str, order: list[str], name: str) -> DataFrame:
    """Numbers from 0 within ``by``."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(by).orderBy(*order)) - 1)
