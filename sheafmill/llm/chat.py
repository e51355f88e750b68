"""Chat formatting with loss masks aligned by offsets.

A conversation is rendered to one string, encoded once with offsets, and the sorted spans of the
assistant turns are intersected with the sorted token spans by binary search: a token is under
the mask if it overlaps a span, and the mask's characters are the overlaps.

Template: ``<|im_start|>ROLE\\nTEXT<|im_end|>\\n`` for each turn. Inside texts and roles the control
strings (of this template and of other common ones) are broken up by a backslash after their first
character and backslashes are doubled, so a text can't end its turn and can be restored exactly; in
a role a line feed is written ``\\n`` as well.

Defined cases: a null text or role is empty; rows are taken by turn, a null turn first, ties by
role and text; repeated rows are turns each; a null conversation id is a conversation of its own;
an empty table gives an empty result; extra columns are not read. A conversation is one output
row, so its size is bounded by what a row can hold; a first turn that many conversations share
costs nothing extra.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

START, END = "<|im_start|>", "<|im_end|>"
#: Strings that mark turns in chat templates, broken up inside texts.
CONTROL = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

_control = re.compile("|".join(map(re.escape, CONTROL)))
_turn = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + r"\n", re.S)
_escaped = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    return _control.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _escaped.sub(r"\1", text)


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return _escaped.sub(lambda m: "\n" if m[1] == "n" else m[1], role)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The string, and the span of each assistant text in it (code points)."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape_role(role)}\n", escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        out += (head, body, END, "\n")
        at += len(head) + len(body) + len(END) + 1
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a rendered string."""
    return [(unescape_role(m[1]), unescape(m[2])) for m in _turn.finditer(formatted)]


def intersect(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Which tokens overlap a span, and the overlaps, neighbouring ones merged.

    Tokens and spans are sorted; parts of one character may share its offsets.
    """
    mask = np.zeros(len(starts), bool)
    kept: list[tuple[int, int]] = []
    for a, b in spans:
        if a == b:
            continue
        low, high = int(np.searchsorted(ends, a, "right")), int(np.searchsorted(starts, b, "left"))
        mask[low:high] = True
        run: list[int] | None = None
        lows, highs = np.maximum(starts[low:high], a), np.minimum(ends[low:high], b)
        breaks = np.flatnonzero(lows[1:] > np.maximum.accumulate(highs)[:-1]) + 1
        for i, j in zip(np.r_[0, breaks], np.r_[breaks, len(lows)], strict=True):
            if j > i:
                run = [int(lows[i]), int(highs[i:j].max())]
                kept.append((run[0], run[1]))
    return mask, kept


@cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.encode_special_tokens = True
    return found


def _format(tokenizer: str, id_type: pa.DataType):
    schema = pa.schema([("conv_id", id_type), ("formatted", pa.string()), ("token_ids", pa.list_(pa.int32())), ("loss_mask", pa.list_(pa.bool_())), ("loss_spans", pa.list_(pa.list_(pa.int64())))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _tokenizer(tokenizer)
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                texts, spans = [], []
                for turns in batch.column(1).to_pylist():
                    text, where = render([(t["role"], t["text"]) for t in turns])
                    texts.append(text)
                    spans.append(where)
                ids, masks, overlaps = [], [], []
                for text, where in zip(texts, spans, strict=True):
                    code = encoder.encode(text, add_special_tokens=False)
                    at = np.array(code.offsets, np.int64).reshape(-1, 2)
                    mask, kept = intersect(at[:, 0], at[:, 1], where)
                    ids.append(np.array(code.ids, np.int32))
                    masks.append(mask)
                    overlaps.append([list(x) for x in kept])
                yield pa.record_batch([batch.column(0).cast(id_type), pa.array(texts, pa.string()), pa.array(ids, pa.list_(pa.int32())), pa.array(masks, pa.list_(pa.bool_())), pa.array(overlaps, pa.list_(pa.list_(pa.int64())))], schema=schema)

    return run


def format_conversations(rows: DataFrame, tokenizer: str) -> DataFrame:
    """A row for each conversation: ``formatted``, ``token_ids``, ``loss_mask`` by token, ``loss_spans``.

    ``rows`` has conv_id, turn, role, text; ``tokenizer`` is the path of a tokenizers JSON file
    on the executors.
    """
    kind = rows.schema["conv_id"].dataType
    slim = rows.select("conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    whole = slim.groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(t["role"], t["text"])).alias("turns"))
    schema = f"conv_id {kind.simpleString()}, formatted string, token_ids array<int>, loss_mask array<boolean>, loss_spans array<array<bigint>>"
    return whole.mapInArrow(_format(tokenizer, to_arrow_type(kind)), schema)


def read_back(formatted: DataFrame) -> DataFrame:
    """What the output says: the turns, and the text under the mask, unescaped."""
    kind = formatted.schema["conv_id"].dataType
    id_type = to_arrow_type(kind)
    turn = pa.struct([("role", pa.string()), ("text", pa.string())])
    schema = pa.schema([("conv_id", id_type), ("turns", pa.list_(turn)), ("loss_text", pa.string()), ("formatted_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turns, losses, chars = [], [], []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                turns.append([{"role": r, "text": t} for r, t in parse(text)])
                losses.append("".join(unescape(text[a:b]) for a, b in spans))
                chars.append(len(text))
            yield pa.record_batch([batch.column(0).cast(id_type), pa.array(turns, pa.list_(turn)), pa.array(losses, pa.string()), pa.array(chars, pa.int64())], schema=schema)

    out = f"conv_id {kind.simpleString()}, turns array<struct<role:string,text:string>>, loss_text string, formatted_chars bigint"
    return formatted.select("conv_id", "formatted", "loss_spans").mapInArrow(run, out)
