"""Cells and headers of raw grids in plain Python, for parsers; ``functions.text`` has them as columns."""

from __future__ import annotations

import re

from ..functions.text import NULLISH, NUMBER

_number = re.compile(NUMBER).match


def one_line(value) -> str:
    """A cell's text on one line; null is empty."""
    if value is None:
        return ""
    lines = (part.strip() for part in str(value).replace("\u00a0", " ").split("\n"))
    return re.sub(r"[ \t]{2,}", " ", " ".join(filter(None, lines)))


def header_key(text: str) -> str:
    """A header as compared: its runs of letters and digits, lower-cased."""
    return " ".join(re.findall("[a-z0-9]+", text.lower()))


def distinct_names(names: list[str]) -> list[str]:
    """Column names: a blank one is col_N, one that came before gets its count."""
    filled = [one_line(n) or f"col_{k}" for k, n in enumerate(names, 1)]
    low = [n.lower() for n in filled]
    counts = [low[: k + 1].count(n) for k, n in enumerate(low)]
    return [n if c == 1 else f"{n}_{c}" for n, c in zip(filled, counts, strict=True)]


def is_label(cell: str) -> bool:
    return len(cell) <= 40 and cell.lower() not in NULLISH and _number(cell) is None


def read_grid(raw: list[list[str]], flagged: bool = False) -> dict | None:
    """Title, columns, has_header, header_row and rows of a grid; None if it is empty."""
    rows = [r for r in raw if any(r)]
    if not rows:
        return None
    width = max(map(len, rows))
    rows = [r + [""] * (width - len(r)) for r in rows]
    title = None
    if width > 1 and len(rows) > 1 and sum(map(bool, rows[0])) == 1 or width == 1 and len(rows) > 2:
        title, rows = next(c for c in rows[0] if c), rows[1:]
    labels = width > 1 and len(rows) > 1 and all(map(is_label, rows[0]))
    header = rows[0] if labels or (flagged and width > 1 and rows) else None
    columns = distinct_names(header) if header else [f"col_{k + 1}" for k in range(width)]
    return {"title": title, "has_header": header is not None, "header_row": header, "columns": columns, "rows": rows[1:] if header else rows}
