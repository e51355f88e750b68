"""Files of any supported kind as one element table; what can't be read is a row with its error."""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from ..schemas import ELEMENT
from . import docx, excel, ocr, pdf

Parser = Callable[[str, bytes], list[dict]]
_COLUMNS = [c.split()[0] for c in ELEMENT.split(", ")]


def pdf_parser(path: str, content: bytes) -> list[dict]:
    """The elements of a PDF by pdfplumber, where that is installed, with OCR text where there is an engine."""
    try:
        import pdfplumber
    except ImportError as error:
        raise ValueError("reading .pdf files needs pdfplumber on the executors") from error
    base = {"file_name": path.rsplit("/", 1)[-1], "source": path}
    with pdfplumber.open(io.BytesIO(content)) as book:
        return [base | e for e in pdf.file_elements(book.pages, ocr.read if ocr.resolve() != "none" else None)]


def word_parser(path: str, content: bytes) -> list[dict]:
    """Word files with the text of their pictures, where there is an OCR engine."""
    return docx.parse(path, content, ocr.read if ocr.resolve() != "none" else None)


def _refuse(kind: str, instead: str, path: str, content: bytes) -> list[dict]:
    raise ValueError(f"{kind} files are not supported; save the file as {instead} first")


PARSERS: dict[str, Parser] = {".xlsx": excel.parse, ".xlsm": excel.parse, ".docx": word_parser, ".pdf": pdf_parser, ".doc": partial(_refuse, ".doc", ".docx"), ".xls": partial(_refuse, ".xls", ".xlsx")}


def load_one(path: str, content: bytes, parsers: dict[str, Parser] | None = None) -> list[dict]:
    """A file's elements, numbered; a failure, or a file without content, is one element with an error."""
    suffix = "." + path.rsplit(".", 1)[-1].lower() if "." in path.rsplit("/", 1)[-1] else ""
    try:
        parser = (parsers or PARSERS).get(suffix)
        if parser is None:
            raise ValueError(f"unsupported file type: {suffix or 'none'}")
        found = parser(path, content)
        if not found:
            raise ValueError("no content could be read from the file")
    except Exception as error:
        found = [{"element_type": "error", "error": f"ingestion failed: {error}", "source": path, "file_name": path.rsplit("/", 1)[-1]}]
    return [e | {"doc_id": path, "element_no": i} for i, e in enumerate(found)]


def parse_files(files: DataFrame, parsers: dict[str, Parser] | None = None) -> DataFrame:
    """Elements of files (path, content), file by file where they lie."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"], strict=True):
                rows = load_one(path, bytes(content), parsers)
                yield pd.DataFrame([{c: r.get(c) for c in _COLUMNS} for r in rows], columns=_COLUMNS).astype(object)

    return files.select("path", "content").mapInPandas(run, ELEMENT)


def read_files(spark: SparkSession, path: str, parsers: dict[str, Parser] | None = None) -> DataFrame:
    return parse_files(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path), parsers)


def good(elements: DataFrame) -> DataFrame:
    return elements.where("error is null")


def errors(elements: DataFrame) -> DataFrame:
    return elements.where("error is not null").select("doc_id", "error")
