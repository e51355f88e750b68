"""Text of pictures: an engine is picked once for each worker, results are kept by the picture's content."""

from __future__ import annotations

import importlib.util
import io
import re
import shutil
from collections.abc import Callable
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.layout import box_text

Engine = Callable[[bytes], str]
#: What a vision model is told.
INSTRUCTION = "Write down all text of this picture, line by line from the top, as it stands. Put ' | ' between the cells of a table's row. Say nothing else."


def resolve(backend: str = "auto") -> str:
    """tesseract, then rapidocr, then none, of those that are there; a stated one is taken as it is."""
    if backend != "auto":
        return backend
    if importlib.util.find_spec("pytesseract") and shutil.which("tesseract"):
        return "tesseract"
    return "rapidocr" if importlib.util.find_spec("rapidocr_onnxruntime") else "none"


def found_text(found: list | None) -> str:
    """Lines and cells of (corners, text, score) as an engine gives them."""
    across = lambda corners, k: [p[k] for p in corners]
    return box_text([{"text": text, "x0": min(across(c, 0)), "x1": max(across(c, 0)), "y0": min(across(c, 1)), "y1": max(across(c, 1))} for c, text, _ in found or []])


def vision(ask: Callable[[str, bytes], str]) -> Engine:
    """An engine out of a model that is asked with an instruction and a picture's bytes; for ``own``."""
    return lambda content: ask(INSTRUCTION, content)


@cache
def engine(backend: str) -> Engine:
    if backend == "tesseract":
        import pytesseract
        from PIL import Image

        return lambda content: pytesseract.image_to_string(Image.open(io.BytesIO(content)), config="--psm 6")
    if backend == "rapidocr":
        from rapidocr_onnxruntime import RapidOCR

        model = RapidOCR()
        return lambda content: found_text(model(content)[0])
    return lambda content: ""


def read(content: bytes, backend: str = "auto") -> str:
    """Text of one picture by this worker's engine; tidy, and empty where it fails."""
    try:
        lines = engine(resolve(backend))(content).split("\n")
    except Exception:
        return ""
    return "\n".join(x for x in (re.sub(r"[ \t]+", " ", line).strip() for line in lines) if x)


def recognise(images: DataFrame, backend: str = "auto", own: Engine | None = None, cache_table: DataFrame | None = None) -> DataFrame:
    """``images`` (content, ...) with ``ocr_text``; equal pictures are read once, failures give an empty text.

    ``cache_table`` has (key, ocr_text) of pictures read before.
    """
    name = resolve(backend) if own is None else "own"
    keyed = images.withColumn("key", F.sha2(F.concat(F.lit(f"{name}:").cast("binary"), "content"), 256))
    todo = keyed.select("key", "content").dropDuplicates(["key"])
    if cache_table is not None:
        todo = todo.join(cache_table.select("key"), "key", "left_anti")

    def run(frames):
        read = own or engine(name)
        for frame in frames:
            texts = []
            for content in frame["content"]:
                try:
                    texts.append(read(bytes(content)))
                except Exception:
                    texts.append("")
            yield pd.DataFrame({"key": frame["key"], "ocr_text": texts})

    fresh = todo.mapInPandas(run, "key string, ocr_text string").select("key", T.tidy(F.col("ocr_text")).alias("ocr_text"))
    known = fresh if cache_table is None else fresh.unionByName(cache_table.select("key", "ocr_text"))
    return keyed.join(known, "key", "left").drop("key")
