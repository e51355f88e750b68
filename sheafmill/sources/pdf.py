"""Pages of a PDF as elements: tables, text in reading order, margins, and what OCR reads.

What words, lines and rotated characters make up are the folds of ``operators.layout``, applied to
one page's objects; this module only knows how to get these from a page, and what follows what.
A page has pdfplumber's ``chars``, ``images``, ``find_tables``, ``extract_words``,
``extract_text_lines``, ``filter``, ``crop`` and ``to_image``.

Defined cases: a page whose tables can't be found has none; one without text gives nothing unless
a picture can be read; a table without any filled cell is none.
"""

from __future__ import annotations

import io
import math
import re
from collections.abc import Callable, Iterator

from ..functions.text import BOLD
from ..operators import layout
from ..operators.tables import stitched
from .cells import header_key, one_line, read_grid

# How near rulings are joined, and how words and turned lines are read.
RULINGS = {"vertical_strategy": "lines", "horizontal_strategy": "lines", "snap_tolerance": 3, "join_tolerance": 3, "intersection_tolerance": 3}
WORDS = {"keep_blank_chars": False, "x_tolerance": 1.5, "y_tolerance": 2, "extra_attrs": ["size"]}
LINES = {"return_chars": True, "strip": True, "line_dir_rotated": "ltr", "char_dir_rotated": "btt"}
#: Resolution for OCR; characters below which a page counts as a scan, and as one if a picture covers a share of it.
DPI, SCAN_CHARS, COVERED_CHARS, COVERED = 300, 40, 300, 0.45
#: Least share of a page of a picture that is read by itself, and least characters of its text.
PICTURE, PICTURE_CHARS = 0.06, 20
#: Points between a heading and the table under it.
ABOVE = 28

Reader = Callable[[bytes], str]


def _middle(char: dict) -> tuple[float, float]:
    return (char["x0"] + char["x1"]) / 2, (char["top"] + char["bottom"]) / 2


def _within(char: dict, box: dict, slack: float = 0.0) -> bool:
    x, y = _middle(char)
    return box["x0"] - slack <= x <= box["x1"] + slack and box["top"] - slack <= y <= box["bottom"] + slack


def _meet(a: dict, b: dict) -> bool:
    return a["x0"] < b["x1"] and b["x0"] < a["x1"] and a["top"] < b["bottom"] and b["top"] < a["bottom"]


def _box(sides) -> dict:
    return dict(zip(("x0", "top", "x1", "bottom"), map(float, sides), strict=True))


def is_diagonal(char: dict) -> bool:
    """:func:`layout.is_diagonal` of one character."""
    if not (matrix := char.get("matrix")):
        return False
    off = abs(math.degrees(math.atan2(matrix[1], matrix[0]))) % 90  # from the nearer lower axis
    return 12 < off < 78


def plain_glyphs(text: str) -> str:
    """:func:`functions.text.unmapped_glyphs` of one text."""
    return re.sub(r"\(cid:\d+\)", "", text.replace("(cid:127)", "•"))


class Page:
    """One page's objects, without stamps in its margins and without diagonal text."""

    def __init__(self, page):
        self.page, self.width, self.height = page, float(page.width), float(page.height)
        self.stamps = layout.stamp_boxes([c | {"upright": c.get("upright", True), "page_width": self.width} for c in page.chars])

    def _readable(self, char: dict) -> bool:
        return not is_diagonal(char) and not any(_within(char, s) for s in self.stamps)

    def _turned(self, cell, stamped: bool) -> str | None:
        """Text of a cell at least half of whose characters are rotated, in their own order; else None."""
        x0, top, x1, bottom = cell
        inside = [c for c in self.page.chars if x0 <= _middle(c)[0] < x1 and top <= _middle(c)[1] < bottom]
        inside = [c for c in inside if not is_diagonal(c) and (stamped or self._readable(c))]
        turned = sum(not c.get("upright", True) for c in inside)
        return "".join(c["text"] for c in inside).strip() if turned and 2 * turned >= len(inside) else None

    def ruled(self) -> Iterator[dict]:
        """Tables between rulings; a stamp's own frame of a row or two is none."""
        for found in self.page.find_tables(table_settings=RULINGS):
            box = _box(found.bbox)
            stamped = any(_meet(box, s) for s in self.stamps)
            if stamped and len(found.rows) <= 2:
                continue
            grid = [list(row) for row in found.extract()]
            for said, row in zip(grid, found.rows, strict=True):
                for k, cell in enumerate(row.cells):
                    text = None if cell is None else self._turned(cell, stamped)
                    said[k] = said[k] if text is None else text
            yield box | {"raw_rows": grid}

    def borderless(self) -> list[dict]:
        upright = self.page.filter(lambda o: o.get("object_type") != "char" or (o.get("upright", True) and self._readable(o)))
        return layout.grids(layout.line_cells(upright.extract_words(**WORDS)))

    def tables(self) -> list[dict]:
        try:
            found = list(self.ruled())
            found += [t for t in self.borderless() if not any(_meet(t, r) for r in found)]
        except Exception:  # one broken page is no broken file
            return []
        out = []
        for t in found:
            read = read_grid([[one_line(c) for c in row] for row in t["raw_rows"]])
            if read is not None:
                banded = read["title"] is not None and len(read["columns"]) > 1
                out.append({k: t[k] for k in ("x0", "top", "x1", "bottom")} | read | {"kind": "side" if banded else "body"})
        return out

    def lines(self, tables: list[dict]) -> list[dict]:
        """Lines outside of tables, cut at wide gaps, with region and whether they are headings."""
        free = self.page.filter(lambda o: o.get("object_type") != "char" or (self._readable(o) and not any(_within(o, t, 1.0) for t in tables)))
        out = []
        for raw in free.extract_text_lines(**LINES):
            parts = layout.caption_segments(raw.get("chars", []))
            for chars in parts if len(parts) > 1 else [None]:
                box = raw if chars is None else {"text": "".join(c["text"] for c in chars), "x0": min(c["x0"] for c in chars), "x1": max(c["x1"] for c in chars), "top": min(c["top"] for c in chars), "bottom": max(c["bottom"] for c in chars)}
                if text := plain_glyphs(box["text"]).strip():
                    out.append(self._line(text, box, raw.get("chars", []) if chars is None else chars))
        return out

    def _line(self, text: str, box: dict, chars: list[dict]) -> dict:
        marked = [bool(re.search(BOLD, c.get("fontname") or "")) for c in chars if c["text"].strip()]
        bold = sum(marked) / len(marked) if marked else 0.0
        if box["bottom"] > 0.94 * self.height:
            region = "footer"
        else:
            region = "header" if box["top"] < 0.04 * self.height and len(text) < 100 and bold < 0.9 else "body"
        heading = region == "body" and bold >= 0.9 and len(text) <= 120 and sum(map(str.isalpha, text)) >= 3
        return {k: box[k] for k in ("x0", "x1", "top", "bottom")} | {"text": text, "height": max(box["bottom"] - box["top"], 1.0), "region": region, "is_heading": heading}

    def items(self, tables: list[dict]) -> list[dict]:
        """Blocks and tables with their column, in reading order; a heading just over a table is the table's."""
        lines = self.lines(tables)
        anchors = layout.page_anchors([x for x in lines if x["region"] == "body"], self.width)
        column = lambda x: min(range(len(anchors)), key=lambda k: abs(anchors[k] - x["x0"]), default=0)
        blocks = layout.text_blocks([x | {"col": column(x)} for x in lines])
        body = [b | {"what": "heading" if b["is_heading"] else "text"} for b in blocks if b["region"] == "body"]
        body += [t | {"what": "table", "col": column(t)} for t in tables if t["kind"] == "body"]
        body.sort(key=lambda x: (x["col"], x["top"]))
        for over, under in zip(body, body[1:], strict=False):
            gap = under["top"] - over["bottom"]
            if (over["what"], under["what"]) == ("heading", "table") and -2 <= gap <= ABOVE and over["x0"] < under["x1"] and under["x0"] < over["x1"]:
                over["taken"], under["heading"] = True, over["text"]
        side = sorted((t | {"what": "table"} for t in tables if t["kind"] == "side"), key=lambda t: (round(t["x0"] / 100), t["top"]))
        return body + side + [b | {"what": "margin"} for b in blocks if b["region"] != "body"]

    def picture_texts(self, chars: int, read: Reader) -> list[str]:
        """What OCR reads of a scan as a whole, or else of its larger pictures."""
        area = max(self.width * self.height, 1)
        share = lambda i: (i["x1"] - i["x0"]) * (i["bottom"] - i["top"]) / area
        if chars < SCAN_CHARS or (chars < COVERED_CHARS and max(map(share, self.page.images), default=0) >= COVERED):
            return [t for t in [self._read(self.page, read)] if t]
        clip = lambda i: (max(0, i["x0"]), max(0, i["top"]), min(self.width, i["x1"]), min(self.height, i["bottom"]))
        texts = [self._read(self.page, read, clip(i)) for i in self.page.images if share(i) >= PICTURE]
        return [t for t in texts if len(t) >= PICTURE_CHARS]

    @staticmethod
    def _read(page, read: Reader, box=None) -> str:
        try:
            part = page if box is None else page.crop(box)
            part.to_image(resolution=DPI).original.save(out := io.BytesIO(), "PNG")
        except Exception:  # a page that can't be drawn has no text
            return ""
        return read(out.getvalue())


def page_elements(page, number: int, section: str | None, read: Reader | None = None) -> tuple[list[dict], str | None]:
    """A page's elements, and the section that is open after it."""
    this = Page(page)
    tables = this.tables()
    place = {"file_type": "pdf", "page": number, "pages": [number]}
    out, chars = [], sum(len(c) for t in tables for row in t["rows"] for c in row)

    def say(text: str, under: str | None, **more) -> None:
        out.append(place | {"element_type": "text", "text": text, "section": under, "is_heading": False, "region": "body"} | more)

    for item in this.items(tables):
        if item["what"] == "table":
            kept = {k: item[k] for k in ("title", "has_header", "columns", "header_row", "rows", "kind", "x0", "x1", "top", "bottom")}
            out.append(place | kept | {"element_type": "table", "section": section, "heading": item.get("heading"), "is_heading": False, "region": "body", "page_height": this.height, "names": [header_key(c) for c in item["columns"]], "merged_parts": 1})
            continue
        if item["what"] == "margin":
            say(item["text"], None, region=item["region"])
            continue
        chars += len(item["text"])
        if item["what"] == "heading":
            section = item["text"]
        if not item.get("taken"):
            say(item["text"], section, is_heading=item["what"] == "heading")
    if read is not None:
        for text in this.picture_texts(chars, read):
            say(text, section, element_type="ocr_text")
    return out, section


def file_elements(pages, read: Reader | None = None) -> list[dict]:
    """All pages' elements in order, tables that page breaks cut put together, tables numbered and titled."""
    section, found = None, []
    for number, page in enumerate(pages, 1):
        part, section = page_elements(page, number, section, read)
        found += part
    body = {id(t) for t in stitched([e for e in found if e.get("kind") == "body"])}
    out = [e for e in found if e.get("kind") != "body" or id(e) in body]
    for number, t in enumerate((e for e in out if e["element_type"] == "table"), 1):
        title = t["title"] or t["heading"] or t["section"] or "Untitled table"
        t |= {"table_id": f"t{number:03d}", "title": title, "headers": t["header_row"] or t["columns"], "n_rows": len(t["rows"])}
    return out
