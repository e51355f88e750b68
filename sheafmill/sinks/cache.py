"""Results kept by key, a table for each kind: what was answered or read before isn't asked again."""

from __future__ import annotations

import logging

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

_log = logging.getLogger(__name__)


def get(spark: SparkSession, root: str | None, kind: str, schema: str) -> DataFrame:
    """What is kept of a kind, a row for each key; without a ``root``, or where nothing can be read, nothing."""
    if root is None:
        return spark.createDataFrame([], schema)
    try:
        kept = spark.read.schema(schema).parquet(f"{root}/{kind}")
        kept.limit(1).count()  # a folder that isn't there, or files that can't be read, show here
    except (PySparkException, Py4JJavaError) as error:
        if "PATH_NOT_FOUND" not in str(error):
            _log.warning("the cache of %s can't be read: %s", kind, error)
        return spark.createDataFrame([], schema)
    return kept.dropDuplicates(["key"])


def put(found: DataFrame, root: str | None, kind: str) -> None:
    """Keep rows (key, ...) whose key isn't kept yet; a commit that fails leaves nothing and is only logged."""
    if root is None:
        return
    known = get(found.sparkSession, root, kind, ", ".join(f"{n} {t}" for n, t in found.dtypes))
    try:
        found.dropDuplicates(["key"]).join(known.select("key"), "key", "left_anti").select(*found.columns).write.mode("append").parquet(f"{root}/{kind}")
    except (PySparkException, Py4JJavaError) as error:
        _log.warning("the cache of %s can't be written: %s", kind, error)
