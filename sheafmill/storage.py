"""Tables that are written once where every executor can read them."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame

_own: list[tempfile.TemporaryDirectory] = []


def settled(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the folder of ``spark.checkpoint.dir`` (one of our own where none is set) and read back.

    What reads it more than once doesn't compute it again, and a lost executor costs a re-read.
    """
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        if not _own:
            _own.append(tempfile.TemporaryDirectory(prefix="sheafmill-"))
            atexit.register(_own[0].cleanup)
        root = f"file://{_own[0].name}"
    path = f"{root.rstrip('/')}/sheafmill-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
