"""Benchmark decontamination: a BM25 index of the test items, asked by every passage of the corpus.

Passages are windows of words, twice as long as the longest item and half overlapping, so an
item that occurs lies within one. An item's impacts are divided by its score against itself, so a
score is the share of the item, by weight, that a passage has. Block-max WAND returns every item
of a score of ``threshold`` or more: a passage's cursors are kept in the order of their items, the
pivot is the first item up to which the lists' largest impacts add up to the threshold, and it is
only scored if the maxima of the blocks that it falls into do so as well; else all cursors skip
to the end of the nearest of these blocks. The passages of a batch are searched at once, each
with its own cursors and pivots, as rows of arrays; what that takes depends on the passages and
their words, not on the number of items.

What is retrieved is verified: of the item's question (all sentences but the last; of a single
sentence the first two thirds) and of its answer (the rest), a share ``overlap`` of the word
trigrams must be in the passage, each.

The index is broadcast. It holds at most ``block_items`` items; more items make more indexes,
made one after another, each of which reads the documents' words again. All have the statistics of all items, so the
number of indexes changes no result.

Defined cases: a null text, an empty one, or an item without words matches nothing; an item
shorter than a trigram is compared by one n-gram of its length; repeated items are reported each;
null or repeated ids are rows like others; without items nothing is contaminated; an empty table
gives an empty result; extra columns stay as they are in :func:`keep_clean` and aren't read
otherwise.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import repeat
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

K1, B = 1.2, 0.75
#: Postings of a block; passages that are searched at once; rows of documents handled at once.
BLOCK, PASSAGES, ROWS = 64, 1024, 512
#: What scores may be off by, as sums of floating-point numbers.
SLACK = 1e-9
#: What sums of largest impacts, of single precision, may be off by: these only say what is scored.
ROUNDING = 1e-4
_word = re.compile(r"\w+").findall
_sentence = re.compile(r"(?<=[.!?])\s+")


def words(text: str | None) -> list[str]:
    return _word(text.lower()) if text else []


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    parts = [p for p in map(words, _sentence.split(text.strip())) if p]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    whole = parts[0] if parts else []
    cut = max(1, len(whole) * 2 // 3)
    return whole[:cut], whole[cut:]


def grams(tokens: list[str], n: int) -> set[tuple[str, ...]]:
    return set(zip(*(tokens[k:] for k in range(n)), strict=False))


def share_in(part: list[str], passage: list[str], n: int = 3) -> float:
    """The share of a part's word n-grams that the passage has; 1 for a part without words."""
    n = min(n, len(part))
    if not n:
        return 1.0
    own = grams(part, n)
    return len(own & grams(passage, n)) / len(own)


class Statistics:
    """Of all items with words, whichever index they are in: their number, mean and largest length, document frequencies."""

    def __init__(self, texts: Iterable[str | None]):
        self.n, self.total, self.longest, self.frequency = 0, 0, 0, Counter()
        for bag in map(words, texts):
            if bag:
                self.n += 1
                self.total += len(bag)
                self.longest = max(self.longest, len(bag))
                self.frequency.update(set(bag))

    @property
    def mean(self) -> float:
        return self.total / self.n if self.n else 1.0


class Index:
    """Inverted index of items with impacts, their maxima and their block maxima; ``statistics`` are those of ``items`` if not given."""

    def __init__(self, items: list[tuple[int, str]], statistics: Statistics | None = None):
        self.ids: list[int] = []
        self.parts: list[tuple[list[str], list[str]]] = []
        bags = []
        for key, text in sorted(((i, t or "") for i, t in items), key=lambda x: (x[0] is None, x[0] or 0, x[1])):
            bag = words(text)
            if bag:
                self.ids.append(key)
                self.parts.append(question_and_answer(text))
                bags.append(Counter(bag))
        sizes = [sum(b.values()) for b in bags]
        known = statistics or Statistics(t for _, t in items)
        self.longest, mean = known.longest, known.mean
        idf = {w: log(1 + (known.n - (n := known.frequency[w]) + 0.5) / (n + 0.5)) for w in {w for b in bags for w in b}}
        self.vocabulary = {w: k for k, w in enumerate(sorted(idf))}
        postings: list[list[tuple[int, float]]] = [[] for _ in self.vocabulary]
        for item, (bag, size) in enumerate(zip(bags, sizes, strict=True)):
            impacts = {w: idf[w] * n * (K1 + 1) / (n + K1 * (1 - B + B * size / mean)) for w, n in bag.items()}
            whole = sum(impacts.values())
            for w, x in impacts.items():
                postings[self.vocabulary[w]].append((item, x / whole))
        postings.append([])  # of a word that isn't in the index
        n, terms = len(self.ids), len(postings)
        lengths = np.array([len(x) for x in postings], np.int64)
        #: Postings lie one list after another; a key is term * (n + 1) + item, so keys are in order throughout.
        self.start = np.cumsum(lengths) - lengths
        self.stop = self.start + lengths
        self.item = np.array([i for x in postings for i, _ in x], np.int32)
        self.impact = np.array([v for x in postings for _, v in x], np.float64)
        self.key = np.repeat(np.arange(terms), lengths) * (n + 1) + self.item
        #: Each list's blocks: where the first is, how many, their largest impacts, and the keys of their last items.
        self.blocks = -(-lengths // BLOCK)
        self.first_block = np.cumsum(self.blocks) - self.blocks
        heads = np.repeat(self.start, self.blocks) + BLOCK * (np.arange(int(self.blocks.sum())) - np.repeat(self.first_block, self.blocks))
        self.block_most = np.maximum.reduceat(self.impact, heads) if len(heads) else np.zeros(0)
        self.block_key = self.key[np.minimum(heads + BLOCK, np.repeat(self.stop, self.blocks)) - 1] if len(heads) else np.zeros(0, np.int64)
        self.most, self.last = np.zeros(terms), np.full(terms, -1, np.int32)
        if len(self.impact):
            some = np.flatnonzero(lengths)
            self.most[some] = np.maximum.reduceat(self.impact, self.start[some])
            self.last[some] = self.item[self.stop[some] - 1]

    def term_ids(self, tokens: list[str]) -> np.ndarray:
        return np.fromiter(map(self.vocabulary.get, tokens, repeat(-1)), np.int64, len(tokens))

    def search(self, which: np.ndarray, terms: np.ndarray, threshold: float, seen: Counter | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(passage, item, score) of all items of a score of ``threshold`` or more, by block-max WAND.

        The passages' distinct terms are given as pairs, sorted by passage. ``seen`` counts the
        items that were scored and the blocks' ends that were skipped to.
        """
        none, least = len(self.ids), threshold - SLACK
        bound = np.float32(least - ROUNDING)  # of sums of single precision
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        heads = np.flatnonzero(np.r_[True, which[1:] != which[:-1]]) if len(which) else np.zeros(0, np.int64)
        # Without enough weight in all lists together there is no first pivot.
        enough = np.add.reduceat(self.most[terms], heads) >= least if len(heads) else np.zeros(0, bool)
        begin, sizes = heads[enough], np.diff(np.r_[heads, len(which)])[enough]
        alike = np.argsort(sizes, kind="stable")  # rows of one block of arrays have about as many terms
        begin, sizes = begin[alike], sizes[alike]
        for low in range(0, len(begin), PASSAGES):
            n = sizes[low : low + PASSAGES]
            width = np.arange(int(n[-1]))[None, :]
            filled = width < n[:, None]
            term = np.where(filled, terms[np.where(filled, begin[low : low + PASSAGES, None] + width, 0)], len(self.most) - 1)
            place, weight = self.start[term], self.most[term].astype(np.float32)
            item = np.where(place < self.stop[term], self.item[np.minimum(place, len(self.item) - 1)], none)
            rows = which[begin[low : low + PASSAGES]]
            bits = max(1, int(n[-1]) - 1).bit_length()
            kind = np.int32 if none << bits < 1 << 31 else np.int64
            item, width, term, place = item.astype(kind), width.astype(kind), term.astype(np.int32), place.astype(np.int32)
            packed = len(rows)
            while len(rows):
                # Cursors in the order of their items, as the item and the cursor's column in one number.
                order = np.sort(item << bits | width, axis=1)
                columns = order & (1 << bits) - 1
                reached = np.cumsum(np.take_along_axis(weight, columns, 1), axis=1) >= bound
                pivot = order[np.arange(len(rows)), reached.argmax(axis=1)] >> bits
                alive = reached[:, -1] & (pivot < none)
                if 2 * int(alive.sum()) < packed:  # the columns anew, without lists that are through
                    packed = int(alive.sum())
                    keep = columns[alive][:, : int((item[alive] < none).sum(axis=1).max(initial=0))]
                    item, term, place, weight = (np.take_along_axis(x[alive], keep, 1) for x in (item, term, place, weight))
                    pivot, rows, width = pivot[alive], rows[alive], width[:, : keep.shape[1]]
                elif not alive.all():
                    item, term, place, weight, pivot, rows = (x[alive] for x in (item, term, place, weight, pivot, rows))
                if not len(rows):
                    break
                inside = item <= pivot[:, None]
                each = inside.sum(axis=1)  # a row has its pivot at least
                starts = np.cumsum(each) - each
                at = np.flatnonzero(inside)
                t, p, now = term.ravel()[at], place.ravel()[at], item.ravel()[at]
                d = np.repeat(pivot, each)
                # The block of each list in which the pivot would be, if the list goes on that far.
                ends, most = self.last[t], weight.ravel()[at]
                long = np.flatnonzero(self.blocks[t] > 1)
                if len(long):
                    block = np.searchsorted(self.block_key, t[long].astype(np.int64) * (none + 1) + d[long])
                    inner = block < self.first_block[t[long]] + self.blocks[t[long]]
                    block = np.where(inner, block, 0)
                    ends[long] = np.where(inner, self.block_key[block] - t[long].astype(np.int64) * (none + 1), -1)
                    most[long] = self.block_most[block]
                in_list = ends >= d
                scored = np.add.reduceat(np.where(in_list, most, np.float32(0)), starts) >= bound
                # Where to go on: after the pivot, or after the nearest end of a block if no item before it can do.
                reach = np.minimum(np.minimum.reduceat(np.where(in_list, ends + 1, none), starts), np.where(inside, none, item).min(axis=1))
                target = np.where(scored, pivot + 1, np.maximum(reach, pivot + 1))
                to = np.repeat(target, each)
                # The next posting often is far enough; a list is searched where it isn't.
                stop, moved = self.stop[t], p + 1
                moved[now >= to] -= 1
                far = np.flatnonzero((moved < stop) & (self.item[np.minimum(moved, len(self.item) - 1)] < to))
                moved[far] = np.searchsorted(self.key, t[far].astype(np.int64) * (none + 1) + to[far])
                hit = np.repeat(scored, each) & (self.item[moved - 1] == d) & (moved > p)
                score = np.add.reduceat(np.where(hit, self.impact[moved - 1], 0.0), starts)
                found = np.flatnonzero(scored & (score >= least))
                out.append((rows[found], pivot[found].astype(np.int64), score[found]))
                if seen is not None:
                    seen.update(scored=int(scored.sum()), skipped=int((~scored).sum()))
                place.ravel()[at] = moved
                item.ravel()[at] = np.where(moved < stop, self.item[np.minimum(moved, len(self.item) - 1)], none)
        return tuple(np.concatenate([x[k] for x in out]) for k in range(3))

    def passages(self, tokens: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The passages of tokenised texts as sorted pairs (passage, term) of known words; each passage's text and first word."""
        step, n_terms = self.longest, len(self.most)
        sizes = np.array([len(t) for t in tokens], np.int64)
        ids = np.concatenate([self.term_ids(t) for t in tokens]) if len(tokens) else np.zeros(0, np.int64)
        begin = np.cumsum(sizes) - sizes
        counts = -(-sizes // step)  # passages of each text; the k-th begins at word k * step
        first = np.cumsum(counts) - counts
        owner = np.repeat(np.arange(len(tokens)), counts)
        known = np.flatnonzero(ids >= 0)
        text = np.searchsorted(begin, known, "right") - 1
        passage = first[text] + (known - begin[text]) // step
        # A word is in the passage that begins before it and in the one before that.
        back = passage > first[text]
        pairs = np.concatenate([passage, passage[back] - 1]) * n_terms + np.concatenate([ids[known], ids[known][back]])
        pairs.sort()
        pairs = pairs[np.r_[True, pairs[1:] != pairs[:-1]]] if len(pairs) else pairs
        passage = pairs // n_terms
        return passage, pairs - passage * n_terms, owner, (np.arange(len(owner)) - first[owner]) * step

    def hits(self, texts: list[str | None], threshold: float, overlap: float) -> list[list[dict]]:
        """Verified items of each text, each once, by its best passage, the first of equals."""
        best: list[dict[int, dict]] = [{} for _ in texts]
        if not self.ids:
            return [[] for _ in texts]
        tokens = [words(t) for t in texts]
        which, terms, owner, begin = self.passages(tokens)
        for k, item, score in zip(*(x.tolist() for x in self.search(which, terms, threshold)), strict=True):
            t, at = int(owner[k]), int(begin[k])
            passage = tokens[t][at : at + 2 * self.longest]
            question, answer = self.parts[item]
            q, a = share_in(question, passage), share_in(answer, passage)
            if q >= overlap and a >= overlap and (item not in best[t] or (score, -at) > (best[t][item]["score"], -best[t][item]["passage"])):
                best[t][item] = {"item_id": self.ids[item], "passage": at, "score": score, "question": q, "answer": a}
        return [[b[i] for i in sorted(b)] for b in best]


def indexes(benchmark: DataFrame, block_items: int = 50_000) -> Iterator[Index]:
    """An index for each block of items, one at a time; besides it the driver has the items' document frequencies.

    Scores and passages are those of one index of all items: the blocks share their statistics.
    """
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    blocks = max(1, -(-items.count() // block_items))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    known = Statistics(r.text for r in items.select("text").toLocalIterator()) if blocks > 1 else None
    for k in range(blocks):
        yield Index([tuple(r) for r in items.where(part == k).collect()], known)


_HIT = pa.struct([("item_id", pa.int64()), ("passage", pa.int64()), ("score", pa.float64()), ("question", pa.float64()), ("answer", pa.float64())])
_HITS = "array<struct<item_id:bigint,passage:bigint,score:double,question:double,answer:double>>"


def contamination(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5, overlap: float = 0.6, id_col: str = "doc_id", text_col: str = "text", block_items: int = 50_000) -> DataFrame:
    """doc_id and ``hits``, a row for each row of ``docs``."""
    kind = docs.schema[id_col].dataType
    schema = pa.schema([("doc_id", to_arrow_type(kind)), ("text", pa.string()), ("hits", pa.list_(_HIT))])
    out = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.array().cast(_HITS).alias("hits"))
    for index in indexes(benchmark, block_items):
        held = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for start in range(0, whole.num_rows, ROWS):
                    batch = whole.slice(start, ROWS)
                    hits = held.value.hits(batch.column(1).to_pylist(), threshold, overlap)
                    found = [sorted((old or []) + new, key=lambda h: (h["item_id"] is not None, h["item_id"] or 0)) for old, new in zip(batch.column(2).to_pylist(), hits, strict=True)]
                    yield pa.record_batch([batch.column(0).cast(schema.field(0).type), batch.column(1).cast(pa.string()), pa.array(found, pa.list_(_HIT))], schema=schema)

        out = out.mapInArrow(run, f"doc_id {kind.simpleString()}, text string, hits {_HITS}")
    return out.select("doc_id", "hits")


def keep_clean(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5, overlap: float = 0.6, text_col: str = "text", block_items: int = 50_000) -> DataFrame:
    """``docs`` without the rows that hold an item."""
    out, place = docs, docs.columns.index(text_col)
    for index in indexes(benchmark, block_items):
        held = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for start in range(0, whole.num_rows, ROWS):
                    batch = whole.slice(start, ROWS)
                    yield batch.filter(pa.array([not found for found in held.value.hits(batch.column(place).to_pylist(), threshold, overlap)], pa.bool_()))

        out = out.mapInArrow(run, docs.schema)
    return out
