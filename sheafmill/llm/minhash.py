"""MinHash near-duplicates with sequential Bayesian verification.

Documents are sets of word shingles. Those with the same sequence of words form a class and only
its smallest id goes on. Signatures are cut into bands; documents that agree on a band share a
bucket.

Candidates are compared by batches of signature values: under a uniform prior the posterior
probability that two documents' similarity reaches the threshold follows from the matches so far,
and a pair is pruned once it is below ``MISS``. The survivors are verified on their whole shingle
sets, read from the texts. Links give components.

A bucket's pairs are never all written out. First each bucket's members meet one pivot, the
first in one of ten orders, by band; what that links is contracted. Only buckets that still hold
more than one component are looked at again, in blocks of bounded size (a large bucket's blocks
are dealt to tasks in pairs). Signatures alone say which members have a partner in another
component that isn't pruned; only these members' texts are dealt, in blocks of bounded bytes, and
compared by all their shingles inside the task, and only links leave it. So none is lost, whatever
a bucket's size.

Defined cases: a null text, or one without words, has no shingles and is linked with nothing; a
text of fewer words than a shingle is one shingle; a null id is linked with nothing and is kept;
rows that repeat an id are one document; an empty table gives an empty result; other columns are
not read, whatever they are called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import frozen, mix64, null_safe, text_buffer
from .components import components, in_tasks

#: 40 bands of 5 values: two documents of similarity 0.8 share no bucket with probability 1.3e-7.
BANDS, ROWS = 40, 5
HASHES = BANDS * ROWS
#: A pair is pruned if the posterior probability that it is similar is below this.
MISS = 1e-8
#: Signature values compared at a time.
BATCH = 20
#: Members of a bucket that are compared in one block, by signatures and by texts, and bytes of texts of a block.
MARKS_BLOCK, TEXTS_BLOCK, BYTES_BLOCK = 4096, 512, 1 << 22
#: Pairs to verify, and members of buckets to compare, of a task.
TASK_PAIRS, TASK_MEMBERS = 2000, 4000
#: Parts of a bucket in joins on it.
SALTS = 16
#: Words of more bytes are hashed one by one: sums of powers modulo 2^64 have known collisions there.
LONG_WORD = 64

_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPAN = 1 << 18
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: list[np.ndarray] = []
_rng = np.random.default_rng(20240229)
_FACTOR = (_rng.integers(0, 1 << 31, HASHES, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_FLIP = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)


def _power_tables() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base mod 2^64 and their inverses."""
    if not _powers:
        inverse = pow(int(_BASE), -1, 1 << 64)
        for base in (_BASE, np.uint64(inverse)):
            steps = np.full(_SPAN, base, np.uint64)
            steps[0] = 1
            _powers.append(np.cumprod(steps, dtype=np.uint64))
    return _powers[0], _powers[1]


def word_hashes(raw: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each white-space separated word of one text's bytes, in order."""
    power, inverse = _power_tables()
    out, low, n = [], 0, len(raw)
    while low < n:
        high = min(low + _SPAN, n)
        if high < n:  # cut at white space, or at the end of a word that is longer than a block
            gaps = np.flatnonzero(_SPACE[raw[low:high]])
            if len(gaps):
                high = low + int(gaps[-1]) + 1
            else:
                while high < n and not _SPACE[raw[high]]:
                    high += 1
                out.append(np.array([xxhash.xxh3_64_intdigest(raw[low:high].tobytes())], np.uint64))
                low = high
                continue
        part = raw[low:high]
        inside = np.concatenate([[False], ~_SPACE[part], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * power[: len(part)], out=total[1:])
        found = mix64((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
        for k in np.flatnonzero(ends - starts > LONG_WORD).tolist():
            found[k] = xxhash.xxh3_64_intdigest(part[starts[k] : ends[k]].tobytes())
        out.append(found)
        low = high
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingle_hashes(raw: np.ndarray, width: int) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles."""
    words = word_hashes(raw)
    if len(words) == 0:
        return words
    size = min(width, len(words))
    mixed = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        mixed = mixed * np.uint64(0xC2B2AE3D27D4EB4F) + words[k : k + len(mixed)]
    return np.unique(mix64(mixed))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """HASHES minima (uint32) for each non-empty set of shingle hashes."""
    at = np.zeros(len(sets) + 1, np.int64)
    np.cumsum([len(s) for s in sets], out=at[1:])
    flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    out = np.full((HASHES, len(sets)), 0xFFFFFFFF, np.uint32)
    step = 1 << 16
    for low in range(0, len(flat), step):
        part = flat[low : low + step]
        first, last = int(np.searchsorted(at, low, "right")) - 1, int(np.searchsorted(at, low + len(part), "left"))
        starts = np.maximum(at[first:last], low) - low
        for h in range(HASHES):
            np.minimum(out[h, first:last], np.minimum.reduceat((part * _FACTOR[h]) ^ _FLIP[h], starts), out=out[h, first:last])
    return out.T


def band_keys(signature: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each row."""
    parts = signature.reshape(len(signature), BANDS, ROWS).astype(np.uint64)
    key = np.zeros(parts.shape[:2], np.uint64)
    for r in range(ROWS):
        key = mix64(key * np.uint64(0x9FB21C651E98DF25) + parts[:, :, r] + np.uint64(1))
    return key.view(np.int64)


def least_matches(threshold: float, miss: float = MISS) -> np.ndarray:
    """By values compared, the fewest matches with which a pair isn't pruned yet.

    Eight bits of each value are kept, so values of different minima match once in 256. With a
    uniform prior on the match rate, its posterior is a beta distribution, whose tail at the
    threshold is a binomial sum.
    """
    rate = threshold + (1 - threshold) / 256
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += comb(n + 1, m) * rate**m * (1 - rate) ** (n + 1 - m)
        out.append(m)
    return np.array(out)


def surviving(left: np.ndarray, right: np.ndarray, floors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs of signature rows (uint8) are never pruned, and their matches."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), np.int32)
    for k, floor in enumerate(floors):
        if not len(alive):
            break
        part = slice(k * BATCH, (k + 1) * BATCH)
        matches[alive] += (left[alive, part] == right[alive, part]).sum(axis=1, dtype=np.int32)
        alive = alive[matches[alive] >= floor]
    return alive, matches[alive]


def shingle_set(text: str, width: int) -> set[tuple[bytes, ...]]:
    """The shingles themselves."""
    words = text.encode().lower().split()
    if len(words) <= width:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(width)), strict=False))


def sign(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    kind = docs.schema[id_col].dataType
    schema = pa.schema([("doc_id", to_arrow_type(kind)), ("n_shingles", pa.int64()), ("words_key", pa.binary()), ("signature", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 128):
                batch = whole.slice(start, 128)
                raw, at = text_buffer(batch.column(1), fold=True)
                sets = [shingle_hashes(raw[a:b], width) for a, b in zip(at[:-1], at[1:], strict=True)]
                some = [i for i, s in enumerate(sets) if len(s)]
                keys, marks, bands = [None] * len(sets), [None] * len(sets), [None] * len(sets)
                if some:
                    found = signatures([sets[i] for i in some])
                    short, rows = found.astype(np.uint8), band_keys(found)
                    for j, i in enumerate(some):
                        words = b" ".join(raw[at[i] : at[i + 1]].tobytes().split())
                        keys[i], marks[i], bands[i] = hashlib.sha256(words).digest(), short[j].tobytes(), rows[j]
                yield pa.record_batch([batch.column(0).cast(schema.field(0).type), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), pa.array(marks, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], schema=schema)

    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, f"doc_id {kind.simpleString()}, n_shingles bigint, words_key binary, signature binary, bands array<bigint>")


def _rows_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, HASHES)


def _prune(kind: str, id_type: pa.DataType, floors: np.ndarray):
    schema = pa.schema([("a", id_type), ("b", id_type)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                alive, _ = surviving(_rows_of(batch.column(2)), _rows_of(batch.column(3)), floors)
                yield pa.record_batch([batch.column(0).take(pa.array(alive)).cast(id_type), batch.column(1).take(pa.array(alive)).cast(id_type)], schema=schema)

    return run, f"a {kind}, b {kind}"


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows with equal leading columns, of a stream that is sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        change = np.zeros(n - 1, bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), n]
        for a, b in zip(cuts, cuts[1:], strict=False):
            key = tuple(c[a] for c in columns)
            if last is not None and key != last:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _rivals(i: int, second: np.ndarray, teams: np.ndarray, sizes: np.ndarray, marks: np.ndarray, bands: np.ndarray, band: int, floors: np.ndarray, threshold: int) -> np.ndarray:
    """Which of the rows ``second`` of other components may be similar to row i, by sizes and signatures.

    A pair that shares several buckets is that of its first one.
    """
    others = second[teams[second] != teams[i]]
    small, large = np.minimum(sizes[others], sizes[i]), np.maximum(sizes[others], sizes[i])
    others = others[100 * small >= threshold * large]
    alive, _ = surviving(np.broadcast_to(marks[i], (len(others), HASHES)), marks[others], floors)
    others = others[alive]
    return others[(bands[others] == bands[i]).argmax(axis=1) == band]


def _block_pairs(group: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """Rows of the first block, each with the rows of the second that it is to meet."""
    block = group.column("block").to_numpy()
    first, second = group.column("first")[0].as_py(), group.column("second")[0].as_py()
    theirs = np.flatnonzero(block == second)
    for i in np.flatnonzero(block == first).tolist():
        yield i, theirs[theirs > i] if first == second else theirs


def _marked_blocks(kind: str, id_type: pa.DataType, floors: np.ndarray, threshold: int):
    """Members of a pair of a bucket's blocks that have a partner which signatures don't prune."""
    schema = pa.schema([("band", pa.int32()), ("key", pa.int64()), ("doc_id", id_type)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, 4):
            teams = np.unique(group.column("component").to_numpy(zero_copy_only=False), return_inverse=True)[1].ravel()
            sizes, marks = group.column("n_shingles").to_numpy(), _rows_of(group.column("signature"))
            bands, band = group.column("bands").flatten().to_numpy().reshape(-1, BANDS), group.column("band")[0].as_py()
            found = np.zeros(group.num_rows, bool)
            for i, others in _block_pairs(group):
                rivals = _rivals(i, others, teams, sizes, marks, bands, band, floors, threshold)
                found[rivals] = True
                found[i] |= len(rivals) > 0
            if found.any():
                yield pa.RecordBatch.from_arrays([group.column(c).filter(pa.array(found)).cast(schema.field(c).type) for c in schema.names], schema=schema)

    return run, f"band int, key bigint, doc_id {kind}"


def _link_blocks(kind: str, id_type: pa.DataType, floors: np.ndarray, threshold: int, width: int):
    """Links between different components in a pair of a bucket's blocks.

    Pairs that signatures don't prune are compared by the hashes of all their shingles. What a
    link joins is one component from then on, so its other pairs needn't be looked at.
    """
    schema = pa.schema([("a", id_type), ("b", id_type)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, 4):
            names = group.column("doc_id").to_numpy(zero_copy_only=False)
            teams = np.unique(group.column("component").to_numpy(zero_copy_only=False), return_inverse=True)[1].ravel()
            sizes, marks = group.column("n_shingles").to_numpy(), _rows_of(group.column("signature"))
            bands, band = group.column("bands").flatten().to_numpy().reshape(-1, BANDS), group.column("band")[0].as_py()
            raw, at = text_buffer(group.column("text"), fold=True)
            sets: dict[int, np.ndarray] = {}

            def shingles(i: int, raw=raw, at=at, sets=sets) -> np.ndarray:
                if i not in sets:
                    sets[i] = shingle_hashes(raw[at[i] : at[i + 1]], width)
                return sets[i]

            pairs = []
            for i, others in _block_pairs(group):
                others = _rivals(i, others, teams, sizes, marks, bands, band, floors, threshold)
                if not len(others):
                    continue
                own = shingles(i)
                each = [shingles(j) for j in others.tolist()]
                flat, starts = np.concatenate(each), np.cumsum([0, *map(len, each)])[:-1]
                both = np.add.reduceat(own[np.minimum(np.searchsorted(own, flat), len(own) - 1)] == flat, starts, dtype=np.int64)
                counts = np.array([len(e) for e in each])
                for j in others[100 * both >= threshold * (len(own) + counts - both)].tolist():
                    if teams[j] != teams[i]:
                        teams[teams == teams[j]] = teams[i]
                        pairs.append((min(names[i], names[j]), max(names[i], names[j])))
            if pairs:
                yield pa.record_batch([pa.array([a for a, _ in pairs], id_type), pa.array([b for _, b in pairs], id_type)], schema=schema)

    return run, f"a {kind}, b {kind}"


def _verify(kind: str, id_type: pa.DataType, width: int, threshold: int):
    """Pairs with both texts; those whose whole shingle sets are similar enough. Equal neighbours are read once."""
    schema = pa.schema([("a", id_type), ("b", id_type)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, set()
        for batch in batches:
            links = []
            for a, b, first, second in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if first != last:
                    last, own = first, shingle_set(first or "", width)
                other = shingle_set(second or "", width)
                both = len(own & other)
                if both and 100 * both >= threshold * (len(own) + len(other) - both):
                    links.append((a, b))
            if links:
                yield pa.record_batch([pa.array([a for a, _ in links], id_type), pa.array([b for _, b in links], id_type)], schema=schema)

    return run, f"a {kind}, b {kind}"


def _with_buckets(members: DataFrame, buckets: DataFrame) -> DataFrame:
    """Members joined to a table of some buckets. That is repeated for SALTS parts, so that a large bucket's members go to as many tasks."""
    salted = members.withColumn("salt", F.pmod(F.xxhash64("doc_id", F.lit("salt")), F.lit(SALTS)).cast("int"))
    parts = buckets.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(parts, ["band", "key", "salt"]).drop("salt")


def _dealt(members: DataFrame, *more: str) -> DataFrame:
    """Members of buckets of so many ``blocks``, once for each pair of blocks that they belong to, in groups by pair."""
    blocked = members.withColumn("block", F.pmod(F.xxhash64("doc_id", F.lit("block")), "blocks").cast("int"))
    dealt = blocked.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("band", "key", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"), "doc_id", "component", "block", "n_shingles", "signature", "bands", *more)
    return dealt.repartition("band", "key", "first", "second").sortWithinPartitions("band", "key", "first", "second")


def near_duplicates(docs: DataFrame, width: int = 5, threshold: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of ``docs``: doc_id, n_shingles, component_id, kept.

    Two documents are linked if ``100 * shared shingles >= threshold * all shingles of both``.
    """
    kind = docs.schema[id_col].dataType
    id_type, name = to_arrow_type(kind), kind.simpleString()
    floors = least_matches(threshold / 100)
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    signed = frozen(sign(slim, width, "doc_id", "text"), "signatures")
    usable = signed.where("n_shingles > 0 and doc_id is not null")
    classes = frozen(usable.groupBy("words_key").agg(F.min("doc_id").alias("representative")), "classes")
    heads = usable.join(classes.select("words_key", F.col("representative").alias("doc_id")), ["words_key", "doc_id"], "left_semi")
    heads = frozen(heads.select("doc_id", "n_shingles", "signature", "bands"), "heads")

    # Buckets of two or more, and the pivot of each.
    members = heads.select("doc_id", F.posexplode("bands").alias("band", "key"))
    buckets = members.groupBy("band", "key").agg(F.count(F.lit(1)).alias("members"), F.min(F.struct(F.xxhash64("doc_id", F.col("band") % 10).alias("h"), "doc_id")).alias("pivot")).where("members > 1").select("band", "key", "members", F.col("pivot.doc_id").alias("pivot"))
    members = frozen(members.join(buckets, ["band", "key"]), "buckets")
    marks = heads.select("doc_id", "n_shingles", "signature")
    texts = frozen(null_safe(slim, members.select("doc_id").distinct(), ["doc_id"], "left_semi"), "texts")

    run_verify, links_as = _verify(name, id_type, width, threshold)

    def verified(pairs: DataFrame, n: int) -> DataFrame:
        """A document with very many partners is a skewed key, which adaptive execution splits."""
        theirs = in_tasks(pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("second")), "b"), n, TASK_PAIRS)
        both = in_tasks(theirs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("first")), "a"), n, TASK_PAIRS)
        return frozen(both.select("a", "b", "first", "second").mapInArrow(run_verify, links_as), "verified")

    run, schema = _prune(name, id_type, floors)
    pairs = members.where("doc_id <> pivot").select(F.least("doc_id", "pivot").alias("a"), F.greatest("doc_id", "pivot").alias("b")).distinct()
    pairs = pairs.join(marks.select(F.col("doc_id").alias("a"), F.col("n_shingles").alias("na"), F.col("signature").alias("sa")), "a").join(marks.select(F.col("doc_id").alias("b"), F.col("n_shingles").alias("nb"), F.col("signature").alias("sb")), "b")
    pairs = frozen(pairs.where(f"100 * least(na, nb) >= {threshold} * greatest(na, nb)").select("a", "b", "sa", "sb").mapInArrow(run, schema), "pairs")
    links = verified(pairs, pairs.count())
    found = frozen(components(links), "components")

    # Buckets that still hold several components: all pairs that may join two are compared in their blocks.
    larger = members.where("members > 2").select("band", "key", "doc_id")
    labelled = frozen(larger.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id")), "labelled")
    mixed = labelled.groupBy("band", "key").agg(F.count(F.lit(1)).alias("members"), F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("band", "key", F.ceil(F.col("members") / MARKS_BLOCK).cast("int").alias("blocks"))
    rest = frozen(_with_buckets(labelled, mixed), "mixed")
    n = rest.count()
    if n:
        run, schema = _marked_blocks(name, id_type, floors, threshold)
        open_members = frozen(in_tasks(_dealt(rest.join(heads, "doc_id")), n, TASK_MEMBERS).mapInArrow(run, schema).distinct(), "open")
        n = open_members.count()
    if n:
        near = rest.drop("blocks").join(open_members, ["band", "key", "doc_id"]).join(heads, "doc_id").join(texts, "doc_id")
        blocks = open_members.join(texts.select("doc_id", F.octet_length("text").alias("size")), "doc_id").groupBy("band", "key").agg(F.ceil(F.greatest(F.count(F.lit(1)) / TEXTS_BLOCK, F.sum("size") / BYTES_BLOCK)).cast("int").alias("blocks"))
        run, schema = _link_blocks(name, id_type, floors, threshold, width)
        more = frozen(in_tasks(_dealt(_with_buckets(near, blocks), "text"), n, TASK_MEMBERS).mapInArrow(run, schema), "more")
        if not more.isEmpty():
            found = frozen(components(links.union(verified(more.distinct(), n))), "components")

    by_set = classes.join(found, classes["representative"] == found["node"], "left").select("words_key", F.coalesce("component", "representative").alias("component"))
    out = signed.select("doc_id", "n_shingles", "words_key").join(by_set, "words_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def deduplicate(docs: DataFrame, width: int = 5, threshold: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the smallest id of each component only, all columns as they were."""
    found = frozen(near_duplicates(docs, width, threshold, id_col, text_col), "near")
    dropped = found.where("not kept").select(F.col("doc_id").alias(id_col)).distinct()
    return null_safe(docs, dropped, [id_col], "left_anti")
