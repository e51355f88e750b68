"""Vectors of texts: hashed words and their pieces, or a model's, and token counts by a tokenizer.

An encoder is any function from a list of texts to a matrix; it is made once in each worker. A
model's prefixes for queries and for passages are put on here, so an encoder doesn't know which of
the two it gets. Vectors are made in Arrow batches, where the rows lie.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from ..functions import text as T

Encoder = Callable[[list[str]], np.ndarray]
DIMENSIONS = 384
#: Texts that a model encodes at once, and words that a worker remembers the grams of.
BATCH, MEMO = 32, 200_000


@dataclass(frozen=True)
class Model:
    """A model's input window in tokens and what it wants before queries and passages."""

    window: int = 256
    query_prefix: str = ""
    passage_prefix: str = ""


_ASKING = "Represent this sentence for searching relevant passages: "
# What the public models want, by a part of their names; others have the default.
MODELS = {
    "all-minilm-l6-v2": Model(256), "all-minilm-l12-v2": Model(256),
    "bge-small-en-v1.5": Model(512, _ASKING), "bge-base-en-v1.5": Model(512, _ASKING), "bge-large-en-v1.5": Model(512, _ASKING),
    "e5-small-v2": Model(512, "query: ", "passage: "), "e5-base-v2": Model(512, "query: ", "passage: "),
}


def model_of(name: str) -> Model:
    return next((m for part, m in MODELS.items() if part in name.lower()), Model())


class _WordGrams(dict):
    """For a word the numbers of its grams: twice the bucket, plus one where it counts as -1."""

    def __init__(self, dimensions: int):
        super().__init__()
        self.dimensions = dimensions

    def __missing__(self, word: str) -> tuple[int, ...]:
        digests = (hashlib.md5(g.encode()).digest() for g in [word, *(word[k : k + 4] for k in range(max(1, len(word) - 3)))])
        grams = tuple(2 * (int.from_bytes(d[:4], "little") % self.dimensions) + (d[4] % 2 == 0) for d in digests)
        if len(self) >= MEMO:
            self.clear()
        self[word] = grams
        return grams


@cache
def hashed(dimensions: int = DIMENSIONS) -> Encoder:
    """Unit vectors of words and their four-letter pieces; one whose grams cancel out is zero."""
    grams = _WordGrams(dimensions)

    def encode(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dimensions))
        for row, text in zip(out, texts, strict=True):
            found = np.fromiter(chain.from_iterable(map(grams.__getitem__, re.findall("[a-z0-9]+", text.lower()))), np.int64)
            counts = np.bincount(found, minlength=2 * dimensions)
            row[:] = counts[::2] - counts[1::2]
        length = np.sqrt((out * out).sum(axis=1, keepdims=True))
        return np.divide(out, length, out=out, where=length > 0)

    return encode


@cache
def pretrained(name: str) -> Encoder:
    """A sentence-transformers model, loaded when a worker first needs it."""
    loaded = []

    def encode(texts: list[str]) -> np.ndarray:
        if not loaded:
            try:
                from sentence_transformers import SentenceTransformer
            except ImportError as error:
                raise ValueError(f"the model {name} needs sentence-transformers on the executors") from error
            loaded.append(SentenceTransformer(name))
        return np.asarray(loaded[0].encode(list(texts), batch_size=BATCH, normalize_embeddings=True))

    return encode


def with_prefix(make: Callable[[], Encoder], prefix: str) -> Callable[[], Encoder]:
    """An encoder of texts with ``prefix`` before each."""
    return lambda: (lambda texts, encode=make(): encode([prefix + t for t in texts])) if prefix else make()


def embedder(name: str | None = None) -> tuple[Callable[[], Encoder], Callable[[], Encoder]]:
    """What makes the encoders of passages and of queries: a named model's, or hashed vectors."""
    if name is None:
        return hashed, hashed
    model = model_of(name)
    make = lambda: pretrained(name)
    return with_prefix(make, model.passage_prefix), with_prefix(make, model.query_prefix)


def _texts(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def vectors(texts: DataFrame, key: str = "chunk_id", text: str = "text", make: Callable[[], Encoder] = hashed) -> DataFrame:
    """(key, embedding): the vector of each text; a null one is empty."""
    kind = StructType([texts.schema[key], StructField("embedding", ArrayType(DoubleType()))])
    arrow = pa.schema([(key, to_arrow_type(texts.schema[key].dataType)), ("embedding", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = make()
        for batch in batches:
            rows = np.asarray(encode(_texts(batch.column(1))), float)
            yield pa.record_batch([batch.column(0).cast(arrow.field(0).type), pa.array(list(rows), pa.list_(pa.float64()))], schema=arrow)

    return texts.select(key, text).mapInArrow(run, kind)


def sparse_vectors(texts: DataFrame, key: str, text: str = "text", make: Callable[[], Encoder] = hashed) -> DataFrame:
    """(key, bucket, weight): the entries of each text's vector that aren't zero."""
    field = texts.schema[key]
    kind = StructType([field, StructField("bucket", IntegerType()), StructField("weight", DoubleType())])
    arrow = pa.schema([(key, to_arrow_type(field.dataType)), ("bucket", pa.int32()), ("weight", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = make()
        for batch in batches:
            dense = np.asarray(encode(_texts(batch.column(1))))
            rows, buckets = np.nonzero(dense)
            yield pa.record_batch([batch.column(0).take(pa.array(rows)).cast(arrow.field(0).type), pa.array(buckets.astype(np.int32)), pa.array(dense[rows, buckets])], schema=arrow)

    return texts.select(key, text).mapInArrow(run, kind)


def near(chunks: DataFrame, queries: DataFrame, key: str = "chunk_id", text: str = "text", passages: Callable[[], Encoder] = hashed, asking: Callable[[], Encoder] = hashed) -> DataFrame:
    """(query_id, key, score): cosine of a stated set of ``queries`` (query_id, query) and each text.

    The queries are encoded once and are a matrix that every batch of texts is multiplied with. A
    text that has no entry in common with a query gets no row for it.
    """
    asked = queries.select("query_id", "query").collect()
    wanted = np.asarray(asking()([r.query or "" for r in asked])) if asked else np.zeros((0, 1))
    numbers = pa.array([r.query_id for r in asked], to_arrow_type(queries.schema["query_id"].dataType))
    field = chunks.schema[key]
    kind = StructType([queries.schema["query_id"], field, StructField("score", DoubleType())])
    arrow = pa.schema([("query_id", numbers.type), (key, to_arrow_type(field.dataType)), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = passages()
        for batch in batches:
            if len(wanted):
                dense = np.asarray(encode(_texts(batch.column(1))))
                rows, which = np.nonzero((dense != 0).astype(np.float32) @ (wanted != 0).astype(np.float32).T)
                yield pa.record_batch([numbers.take(pa.array(which)), batch.column(0).take(pa.array(rows)).cast(arrow.field(1).type), pa.array((dense @ wanted.T)[rows, which])], schema=arrow)

    return chunks.select(key, text).mapInArrow(run, kind)


# ---- tokens -----------------------------------------------------------------


@cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    return made


def token_counter(path: str | None = None) -> Callable[[Column], Column]:
    """Counts a text's tokens: by a tokenizer's file on the executors, or the estimate without one."""
    if path is None:
        return T.token_cost

    @F.pandas_udf("bigint")
    def count(texts: pd.Series) -> pd.Series:
        found = _tokenizer(path).encode_batch([t or "" for t in texts], add_special_tokens=False)
        return pd.Series([len(x.ids) for x in found], dtype="int64")

    return count


def counting(path: str | None = None) -> Callable[[str], int]:
    """:func:`token_counter` for folds in Python."""
    if path is None:
        from .chunk import word_pieces

        return word_pieces
    return lambda text: len(_tokenizer(path).encode(text, add_special_tokens=False).ids)
