"""Folds over groups of ordered rows, for what depends on what was already put together.

Groups are streamed out of sorted partitions, so a task holds one group at a time and there is no
cost for each group but its rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def fold_groups(rows: DataFrame, keys: list[str], order: list[str], schema: str | StructType, fold: Callable[[list[dict]], Iterable[dict]]) -> DataFrame:
    """``fold`` makes the result rows of a group out of its rows in order; keys are added to each."""
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = (row for batch in batches for row in batch.to_pylist())
        out: list[dict] = []
        for key, group in groupby(stream, key=lambda r: tuple(r[k] for k in keys)):
            named = dict(zip(keys, key, strict=True))
            out += [{**r, **named} for r in fold(list(group))]
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, kind)
