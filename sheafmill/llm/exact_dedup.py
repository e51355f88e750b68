"""Exact deduplication by an exchange of Golomb-coded fingerprints.

1. Every block of input rows (a *sender*) hashes its normalised texts and sends, to the owner
   of each fingerprint range, its distinct fingerprints: sorted, as differences, Golomb coded.
2. An owner finds the fingerprints that more than one sender has and returns a bitmap.
3. A sender marks as suspects the rows whose fingerprint is marked there or that it holds
   more than once itself.
4. Only the suspects' texts are shuffled. They are grouped by their bytes.

A sender sends a fingerprint once however many rows have it, so a text that makes up a third of
all rows costs an owner one code per sender; the byte verification aggregates before it
shuffles. Nothing is collected.

Defined cases: a null text counts as empty; texts are equal if they are the same after
lower-casing A-Z only; of equal texts the largest id stays and a null id is smaller than any
other; rows that repeat both id and text each get a row in :func:`duplicates`, and
:func:`deduplicate` keeps one of them. An empty table gives an empty result. Columns other than
the two named are not read, whatever they are called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import frozen, input_partitions, null_safe, pieces, pow2_at_least

#: Bits of a fingerprint that travel. Suspects are verified, so it only sets how many are false.
FINGERPRINT_BITS = 48
#: Rows of a sender.
BLOCK_ROWS = 1 << 17


def golomb_encode(values: np.ndarray, start: int = 0) -> bytes:
    """Sorted unsigned integers from ``start`` as Golomb codes of their differences.

    The parameter is a power of two near the mean difference. The remainders come first, then the
    unary quotients, so that both can be read as whole arrays; a head of five bytes has the number
    of values and the parameter.
    """
    n = len(values)
    if n == 0:
        return b""
    gaps = np.diff(values.astype(np.uint64), prepend=np.uint64(start))
    k = max(0, ((int(values[-1]) - start) // n).bit_length() - 1)
    quotients = (gaps >> np.uint64(k)).astype(np.int64)
    ends = np.cumsum(quotients + 1)
    unary = np.ones(int(ends[-1]), np.uint8)
    unary[ends - 1] = 0
    shifts = np.arange(k - 1, -1, -1, dtype=np.uint64)
    rest = ((gaps[:, None] >> shifts[None, :]) & np.uint64(1)).astype(np.uint8)
    return np.array([n], "<u4").tobytes() + bytes([k]) + np.packbits(rest.ravel()).tobytes() + np.packbits(unary).tobytes()


def golomb_decode(code: bytes, start: int = 0) -> np.ndarray:
    if not code:
        return np.zeros(0, np.uint64)
    n, k = int(np.frombuffer(code, "<u4", 1)[0]), code[4]
    body = np.frombuffer(code, np.uint8, offset=5)
    cut = (n * k + 7) // 8
    stops = np.flatnonzero(np.unpackbits(body[cut:]) == 0)[:n]
    quotients = np.diff(stops, prepend=-1) - 1
    gaps = quotients.astype(np.uint64) << np.uint64(k)
    rest = np.unpackbits(body[:cut], count=n * k).reshape(n, k) if k else np.zeros((n, 0), np.uint8)
    for bit in range(k):
        gaps |= rest[:, bit].astype(np.uint64) << np.uint64(k - 1 - bit)
    return np.cumsum(gaps, dtype=np.uint64) + np.uint64(start)


def owned(values: np.ndarray, owners: int, bits: int) -> tuple[list[int], list[int], list[int], int]:
    """Owners (a power of two) of sorted ``bits``-bit values, where each one's range begins and ends, and how many bits are below an owner's number."""
    shift = bits - (owners.bit_length() - 1)
    own = values >> np.uint64(shift)
    first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.zeros(0, np.int64)
    return own[first].astype(np.int64).tolist(), first.tolist(), np.r_[first[1:], len(own)][: len(first)].tolist(), shift


def _fingerprints(digests: np.ndarray) -> np.ndarray:
    """The leading bits of SHA-256 digests (rows of 32 bytes)."""
    head = np.ascontiguousarray(digests[:, :8]).view(">u8").ravel().astype(np.uint64)
    return head >> np.uint64(64 - FINGERPRINT_BITS)


def _digests(column: pa.Array) -> np.ndarray:
    flat = b"".join(column.to_pylist())
    return np.frombuffer(flat, np.uint8).reshape(-1, 32)


def _send(id_type: pa.DataType, owners: int):
    fields = [("kind", pa.int32()), ("sender", pa.int64()), ("doc_id", id_type), ("digest", pa.binary()), ("owner", pa.int32()), ("code", pa.binary())]
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, block, rows, held = TaskContext.get().partitionId(), 0, 0, []

        def flush():
            sender = (task << 24) | block
            distinct = np.unique(_fingerprints(np.concatenate(held)))
            some, lows, highs, shift = owned(distinct, owners, FINGERPRINT_BITS)
            codes = [(o, golomb_encode(distinct[a:b], o << shift)) for o, a, b in zip(some, lows, highs, strict=True)]
            n = len(codes)
            return pa.record_batch([pa.array([1] * n, pa.int32()), pa.array([sender] * n, pa.int64()), pa.nulls(n, id_type), pa.nulls(n, pa.binary()), pa.array([o for o, _ in codes], pa.int32()), pa.array([c for _, c in codes], pa.binary())], schema=schema)

        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                n = part.num_rows
                if rows and rows + n > BLOCK_ROWS:
                    yield flush()
                    block, rows, held = block + 1, 0, []
                hashes = [hashlib.sha256(x).digest() for x in pieces(part.column(1), fold=True)]
                held.append(np.frombuffer(b"".join(hashes), np.uint8).reshape(-1, 32))
                rows += n
                yield pa.record_batch([pa.array(np.zeros(n, np.int32)), pa.array(np.full(n, (task << 24) | block, np.int64)), part.column(0).cast(id_type), pa.array(hashes, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], schema=schema)
        if rows:
            yield flush()

    return run


def _own(table: pa.Table) -> pa.Table:
    """One owner: which of the fingerprints that it got came from two senders or more.

    It needn't know where its range starts: that shifts all of its fingerprints alike.
    """
    codes = [golomb_decode(c) for c in table.column("code").to_pylist()]
    seen, times = np.unique(np.concatenate(codes), return_counts=True)
    shared = seen[times > 1]
    bitmaps = [np.packbits(np.isin(c, shared, assume_unique=True)).tobytes() for c in codes]
    return pa.table({"sender": table.column("sender"), "owner": table.column("owner"), "bitmap": pa.array(bitmaps, pa.binary())})


def _mark(owners: int, id_type: pa.DataType):
    def run(rows: pa.Table, replies: pa.Table) -> pa.Table:
        if rows.num_rows == 0:
            return pa.table({"doc_id": pa.nulls(0, id_type), "digest": pa.nulls(0, pa.binary()), "suspect": pa.nulls(0, pa.bool_())})
        prints = _fingerprints(_digests(rows.column("digest")))
        distinct, where, times = np.unique(prints, return_inverse=True, return_counts=True)
        marked = times > 1
        some, lows, highs, _ = owned(distinct, owners, FINGERPRINT_BITS)
        place = {o: (a, b) for o, a, b in zip(some, lows, highs, strict=True)}
        for owner, bitmap in zip(replies.column("owner").to_pylist(), replies.column("bitmap").to_pylist(), strict=True):
            a, b = place[owner]
            marked[a:b] |= np.unpackbits(np.frombuffer(bitmap, np.uint8), count=b - a).astype(bool)
        return pa.table({"doc_id": rows.column("doc_id").cast(id_type), "digest": rows.column("digest"), "suspect": pa.array(marked[where.ravel()])})

    return run


def _normalised(id_type: pa.DataType):
    schema = pa.schema([("doc_id", id_type), ("digest", pa.binary()), ("folded", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [bytes(x) for x in pieces(batch.column(1), fold=True)]
            yield pa.record_batch([batch.column(0).cast(id_type), pa.array([hashlib.sha256(x).digest() for x in texts], pa.binary()), pa.array(texts, pa.binary())], schema=schema)

    return run


def duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of ``docs``: its id, ``keep_id``, ``group_size``, ``kept`` and ``digest``."""
    kind = docs.schema[id_col].dataType
    id_type = to_arrow_type(kind)
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # As many as there are blocks of input, so an owner's share doesn't grow with the data.
    owners = pow2_at_least(2 * input_partitions(slim))
    wire = f"kind int, sender long, doc_id {kind.simpleString()}, digest binary, owner int, code binary"
    sent = frozen(slim.mapInArrow(_send(id_type, owners), wire), "fingerprints")
    replies = sent.where("kind = 1").select("sender", "owner", "code").groupBy("owner").applyInArrow(_own, "sender long, owner int, bitmap binary")
    marked_as = f"doc_id {kind.simpleString()}, digest binary, suspect boolean"
    rows = sent.where("kind = 0").select("sender", "doc_id", "digest")
    marked = frozen(rows.groupBy("sender").cogroup(replies.groupBy("sender")).applyInArrow(_mark(owners, id_type), marked_as), "suspects")
    ids = marked.where("suspect").select("doc_id").distinct()
    folded = f"doc_id {kind.simpleString()}, digest binary, folded binary"
    texts = null_safe(slim, ids, ["doc_id"], "left_semi").mapInArrow(_normalised(id_type), folded)
    groups = texts.groupBy("digest", "folded").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")).where("group_size > 1").drop("folded")
    found = marked.join(groups, "digest", "left")
    size = F.coalesce("group_size", F.lit(1).cast("long"))
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return found.select("doc_id", keep.alias("keep_id"), size.alias("group_size"), F.col("doc_id").eqNullSafe(keep).alias("kept"), "digest")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all its columns as they were."""
    found = frozen(duplicates(docs, id_col, text_col), "exact")
    dropped = found.where("not kept").select(F.col("doc_id").alias(id_col)).distinct()
    again = found.where("kept").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("doc_id").alias(id_col))
    odd = dropped.unionByName(again).distinct()
    plain = null_safe(docs, odd, [id_col], "left_anti")
    # An id in ``odd`` may repeat: with a text that stays and another that goes, or twice with
    # the same. These few rows are decided by their own digest, and one of each is taken.
    digest = F.unhex(F.sha2(F.translate(F.coalesce(F.col(text_col), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").cast("binary"), 256))
    stays = null_safe(found.where("kept"), odd.withColumnRenamed(id_col, "doc_id"), ["doc_id"], "left_semi").select("doc_id", "digest").distinct()
    columns = docs.columns
    rows = null_safe(docs, stays.select(F.col("doc_id").alias(id_col)).distinct(), [id_col], "left_semi").select(F.struct(*columns).alias("__row"), F.col(id_col).alias("doc_id"), digest.alias("digest"))
    rest = null_safe(rows, stays, ["doc_id", "digest"], "left_semi").groupBy("doc_id", "digest").agg(F.first("__row").alias("__row")).select("__row.*")
    return plain.unionByName(rest)
