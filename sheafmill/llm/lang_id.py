"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed 1- to 3-grams of the lower-cased text's code points. A text's vector is the
share of each bucket among its n-grams times the bucket's inverse document frequency, which is
counted over all training rows. The weights are fitted by follow-the-regularised-leader (FTRL
proximal) with an elastic-net penalty on a sample of at most about ``per_class`` rows of each
language; one fifth of it is held back to calibrate the temperature of the probabilities.
A prediction is a sum of table rows over a text's n-grams, so it is linear in the text's length.

The fit runs in one task on the bounded sample and the BUCKETS document frequencies. What reaches
the driver is a count for each language and the weights (BUCKETS x languages), which are broadcast;
more than ``MAX_CLASSES`` languages are an error.

Defined cases: a text that is null or has no letter is ``und`` with score 1; without a labelled
training row everything is ``und`` with score 0; with one language it is that one; a null id is
neither held out nor trained on; repeated rows each get a row; an empty table gives an empty
result. Only the three named columns are read, and lang only of training rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

BUCKETS = 1 << 16
ORDERS = 3
#: Code points handled at once.
BLOCK = 1 << 19
#: Vectors are scaled by this, so that gradients are not tiny.
SCALE = 20.0
#: Most languages of a model; its table has BUCKETS numbers for each.
MAX_CLASSES = 256

_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)
_SEEDS = np.array([0x27D4EB2F, 0x165667B1, 0xD3A2646C], np.uint32)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The lower-cased texts' code points in one array, and the n + 1 offsets of the texts."""
    low = [t.lower() for t in texts]
    at = np.zeros(len(low) + 1, np.int64)
    np.cumsum([len(t) for t in low], out=at[1:])
    return np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32), at


def buckets(points: np.ndarray, at: np.ndarray, low: int, high: int) -> Iterator[np.ndarray]:
    """For each order, the bucket of the n-gram at each position from low to high.

    Where an n-gram would run over its text's end, it is BUCKETS, which counts for nothing.
    """
    ends = at[1:]
    ends = ends[(ends > low) & (ends < high + ORDERS)]
    size = high - low
    for order in range(ORDERS):
        mixed = np.full(size, _SEEDS[order], np.uint32)
        for k in range(order + 1):
            part = points[low + k : high + k]
            mixed[: len(part)] += (part + np.uint32(1)) * _MULTIPLIERS[k]
            mixed ^= mixed >> np.uint32(13)
            mixed *= np.uint32(0x2C1B3C6D)
        out = (mixed >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int32)
        for k in range(1, order + 1):
            over = ends - k - low
            out[over[(over >= 0) & (over < size)]] = BUCKETS
        yield out


def sums(points: np.ndarray, at: np.ndarray, table: np.ndarray) -> np.ndarray:
    """For each text the mean of its n-grams' rows of ``table`` (BUCKETS + 1 rows, the last zero)."""
    n = len(at) - 1
    out = np.zeros((n, table.shape[1]))
    for low in range(0, len(points), BLOCK):
        high = min(low + BLOCK, len(points))
        first, last = int(np.searchsorted(at, low, "right")) - 1, int(np.searchsorted(at, high, "left"))
        rows = np.arange(first, last)
        rows = rows[at[rows + 1] > at[rows]]
        starts = np.maximum(at[rows], low) - low
        for found in buckets(points, at, low, high):
            out[rows] += np.add.reduceat(table[found], starts, axis=0)
    sizes = np.diff(at)
    grams = sum(np.maximum(sizes - k, 0) for k in range(ORDERS))
    return out / np.maximum(grams, 1)[:, None]


@dataclass(frozen=True)
class Model:
    classes: tuple[str, ...]
    #: (BUCKETS + 1) x classes: weights times inverse document frequency times SCALE.
    table: np.ndarray
    bias: np.ndarray
    temperature: float

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        lettered = np.array([any(map(str.isalpha, t)) for t in texts], bool)
        if not self.classes:
            return ["und"] * len(texts), np.where(lettered, 0.0, 1.0)
        logits = (sums(*code_points(texts), self.table) + self.bias) / self.temperature
        shares = softmax(logits)
        best = shares.argmax(axis=1) if len(texts) else np.zeros(0, int)
        names = [self.classes[b] if ok else "und" for b, ok in zip(best.tolist(), lettered.tolist(), strict=True)]
        return names, np.where(lettered, shares.max(axis=1, initial=0.0), 1.0)


def softmax(logits: np.ndarray) -> np.ndarray:
    if logits.shape[1] == 0:
        return logits
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(vectors: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, n_classes: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.05, epochs: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal on sparse vectors (bucket ids, values); weights (BUCKETS x classes) and bias.

    The elastic net is in the closed form of the weights: those whose accumulated gradient is
    within ``l1`` are zero, the others are shrunk by ``l2``.
    """
    z, n = np.zeros((BUCKETS + 1, n_classes)), np.zeros((BUCKETS + 1, n_classes))

    def weights(rows):
        zr, nr = z[rows], n[rows]
        return np.where(np.abs(zr) > l1, -(zr - np.sign(zr) * l1) / ((beta + np.sqrt(nr)) / alpha + l2), 0.0)

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(vectors)):
            ids, x = vectors[i]
            rows, x = np.append(ids, BUCKETS), np.append(x, 1.0)  # the last row is the bias
            w = weights(rows)
            logits = x @ w
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[labels[i]] -= 1
            g = x[:, None] * p
            grown = n[rows] + g * g
            z[rows] += g - (np.sqrt(grown) - np.sqrt(n[rows])) / alpha * w
            n[rows] = grown
    w = weights(np.arange(BUCKETS + 1))
    return w[:BUCKETS], w[BUCKETS]


def calibrate(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search on its logarithm."""
    if len(labels) == 0:
        return 1.0
    loss = lambda t: -np.log(softmax(logits / np.exp(t))[np.arange(len(labels)), labels] + 1e-12).mean()
    a, b, r = np.log(0.05), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(40):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Document frequencies of a task's rows, and the vectors of those in the sample."""
    schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64()), ("lang", pa.string()), ("tie", pa.int64()), ("ids", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))])
    frequency, seen = np.zeros(BUCKETS + 1, np.int64), np.zeros(BUCKETS + 1, bool)
    rows = 0
    for whole in batches:
        for start in range(0, whole.num_rows, 64):
            batch = whole.slice(start, 64)
            points, at = code_points(batch.column(0).to_pylist())
            langs, ties, ids, counts = [], [], [], []
            for i, (lang, sampled, tie) in enumerate(zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True)):
                own = np.zeros(BUCKETS + 1, np.int32) if sampled else None
                local, size = points[at[i] : at[i + 1]], int(at[i + 1] - at[i])
                seen[:] = False
                for low in range(0, size, BLOCK):
                    for found in buckets(local, np.array([0, size]), low, min(low + BLOCK, size)):
                        seen[found] = True
                        if own is not None:
                            own += np.bincount(found, minlength=BUCKETS + 1).astype(np.int32)
                frequency += seen
                rows += 1
                if own is not None:
                    own[BUCKETS] = 0
                    at_once = np.flatnonzero(own)
                    langs.append(lang)
                    ties.append(tie)
                    ids.append(at_once.astype(np.int32))
                    counts.append(own[at_once])
            if langs:
                k = len(langs)
                yield pa.record_batch([pa.nulls(k, pa.int32()), pa.nulls(k, pa.int64()), pa.array(langs, pa.string()), pa.array(ties, pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))], schema=schema)
    frequency[BUCKETS] = rows
    some = np.flatnonzero(frequency)
    k = len(some)
    if k:
        yield pa.record_batch([pa.array(some.astype(np.int32)), pa.array(frequency[some]), pa.nulls(k, pa.string()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.list_(pa.int32())), pa.nulls(k, pa.list_(pa.int32()))], schema=schema)


def _fit_task(classes: tuple[str, ...]):
    """One task: document frequencies and the sample (rows of _count's format) to a row of the fitted numbers."""
    schema = pa.schema([("weights", pa.binary()), ("bias", pa.binary()), ("temperature", pa.float64())])
    place = {c: i for i, c in enumerate(classes)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency = np.zeros(BUCKETS + 1)
        labels, found = [], []
        for batch in batches:
            known = batch.filter(pc.is_valid(batch.column(0)))
            frequency[known.column(0).to_numpy()] = known.column(1).to_numpy()
            own = batch.filter(pc.is_valid(batch.column(2)))
            labels += [place[x] for x in own.column(2).to_pylist()]
            found += [(i.values.to_numpy().copy(), c.values.to_numpy().copy()) for i, c in zip(own.column(4), own.column(5), strict=True)]
        idf = np.log((1 + frequency[BUCKETS]) / (1 + frequency[:BUCKETS])) + 1
        vectors = [(i, c / max(1, c.sum()) * idf[i] * SCALE) for i, c in found]
        # A fixed order, whatever order the tasks ended in.
        order = sorted(range(len(vectors)), key=lambda k: (labels[k], len(vectors[k][0]), vectors[k][0].tobytes(), vectors[k][1].tobytes()))
        vectors, labels = [vectors[k] for k in order], np.array([labels[k] for k in order], int)
        back = np.arange(len(vectors)) % 5 == 4
        ahead = np.flatnonzero(~back)
        weights, bias = fit([vectors[k] for k in ahead], labels[ahead], len(classes))
        logits = np.array([x @ weights[i] + bias for (i, x), b in zip(vectors, back, strict=True) if b]).reshape(-1, len(classes))
        table = (weights * idf[:, None] * SCALE).astype(np.float32)
        yield pa.record_batch([pa.array([table.tobytes()], pa.binary()), pa.array([bias.astype(np.float64).tobytes()], pa.binary()), pa.array([calibrate(logits, labels[back])], pa.float64())], schema=schema)

    return run


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_class: int = 800) -> Model:
    """Fit on the labelled rows that are not held out."""
    from .common import frozen

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where(F.col("id").isNotNull() & ~held_out(F.col("id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy("lang").count().limit(MAX_CLASSES + 1).collect()}
    classes = tuple(sorted(sizes))
    if len(classes) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} languages")
    if not classes:
        return Model((), np.zeros((BUCKETS + 1, 0), np.float32), np.zeros(0), 1.0)
    share = F.create_map(*[F.lit(x) for c in classes for x in (c, min(1.0, per_class / sizes[c]))])
    tie = F.xxhash64("id", F.lit("sample"))
    sampled = F.pmod(tie, F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20)
    counted = frozen(rows.select("text", "lang", sampled.alias("sampled"), tie.alias("tie")).mapInArrow(_count, "bucket int, n bigint, lang string, tie bigint, ids array<int>, counts array<int>"), "ngrams")
    none = [F.lit(None).cast(t).alias(c) for c, t in counted.dtypes if c not in ("bucket", "n")]
    frequency = counted.where("bucket is not null").groupBy("bucket").agg(F.sum("n").alias("n")).select("bucket", "n", *none)
    # Should the hash draw many more rows than expected, the same ones are left out whatever the order of tasks.
    sample = counted.where("lang is not null").orderBy("tie", "lang").limit(2 * per_class * len(classes))
    fitted = frequency.unionByName(sample).coalesce(1).mapInArrow(_fit_task(classes), "weights binary, bias binary, temperature double").first()
    table = np.zeros((BUCKETS + 1, len(classes)), np.float32)
    table[:BUCKETS] = np.frombuffer(fitted["weights"], np.float32).reshape(BUCKETS, len(classes))
    return Model(classes, table, np.frombuffer(fitted["bias"], np.float64), fitted["temperature"])


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred and score, a row for each row of ``docs``."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType
    schema = pa.schema([("doc_id", to_arrow_type(kind)), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 128):
                batch = whole.slice(start, 128)
                names, scores = held.value.predict([t or "" for t in batch.column(2).to_pylist()])
                yield pa.record_batch([batch.column(0).cast(schema.field(0).type), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())], schema=schema)

    slim = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, f"doc_id {kind.simpleString()}, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text", least: float = 0.35) -> DataFrame:
    """``docs`` without the rows that are ``und`` or whose language has a score below ``least``."""
    held, columns, place = docs.sparkSession.sparkContext.broadcast(model), docs.schema, docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 128):
                batch = whole.slice(start, 128)
                names, scores = held.value.predict([t or "" for t in batch.column(place).to_pylist()])
                yield batch.filter(pa.array([n != "und" and s >= least for n, s in zip(names, scores.tolist(), strict=True)], pa.bool_()))

    return docs.mapInArrow(run, columns)
