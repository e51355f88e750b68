"""Word documents with the standard library: headings, paragraphs, captions and tables in body order."""

from __future__ import annotations

import io
import zipfile
from xml.etree import ElementTree

from .cells import header_key, one_line, read_grid

_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
SHORT = 100
#: Pixels below which a picture is an icon, and least characters of text that one is kept for.
PIXELS, PICTURE_CHARS = 40_000, 20


def _text(node) -> str:
    out = []
    for x in node.iter():
        if x.tag == f"{_W}t":
            out.append(x.text or "")
        elif x.tag == f"{_W}tab":
            out.append("\t")
        elif x.tag in (f"{_W}br", f"{_W}cr"):
            out.append("\n")
    return "".join(out).strip()


def _styles(archive: zipfile.ZipFile) -> dict[str, str]:
    if "word/styles.xml" not in archive.namelist():
        return {}
    root = ElementTree.fromstring(archive.read("word/styles.xml"))
    return {s.get(f"{_W}styleId"): (s.find(f"{_W}name").get(f"{_W}val") if s.find(f"{_W}name") is not None else "") for s in root.iter(f"{_W}style")}


def _is_heading(paragraph, styles: dict[str, str], text: str) -> bool:
    """By style, or a short paragraph that is bold throughout."""
    style = paragraph.find(f"{_W}pPr/{_W}pStyle")
    name = styles.get(style.get(f"{_W}val"), style.get(f"{_W}val")) if style is not None else ""
    if name.lower().startswith("heading") or name.lower() == "title":
        return True
    runs = [r for r in paragraph.iter(f"{_W}r") if _text(r)]
    bold = lambda r: (b := r.find(f"{_W}rPr/{_W}b")) is not None and b.get(f"{_W}val", "1") not in ("0", "false")
    return bool(runs) and len(text) <= SHORT and all(map(bold, runs))


def _grid(table) -> tuple[list[list[str]], bool]:
    """Cells by row, a merged cell once, and whether the first row is marked as the header."""
    rows = []
    nodes = table.findall(f"{_W}tr")
    for node in nodes:
        rows.append([one_line("\n".join(_text(p) for p in c.iter(f"{_W}p"))) for c in node.findall(f"{_W}tc")])
    flagged = bool(nodes) and nodes[0].find(f"{_W}trPr/{_W}tblHeader") is not None
    return rows, flagged


def picture_pixels(content: bytes) -> int | None:
    """Width times height by the head of a PNG, GIF, BMP or JPEG; None of anything else."""
    number = lambda a, b, order="big": int.from_bytes(content[a:b], order)
    if content[:8] == b"\x89PNG\r\n\x1a\n":
        return number(16, 20) * number(20, 24)
    if content[:4] == b"GIF8":
        return number(6, 8, "little") * number(8, 10, "little")
    if content[:2] == b"BM":
        return number(18, 22, "little") * abs(int.from_bytes(content[22:26], "little", signed=True))
    at = 2 if content[:2] == b"\xff\xd8" else len(content)
    while at + 9 < len(content) and content[at] == 0xFF:
        kind = content[at + 1]
        if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
            return number(at + 5, at + 7) * number(at + 7, at + 9)
        at += 2 + number(at + 2, at + 4)
    return None


def parse(path: str, content: bytes, recognise=None) -> list[dict]:
    """The elements of a document. ``recognise`` reads the text of an embedded picture's bytes, if given."""
    out: list[dict] = []
    waiting: list[str] = []
    section = None
    base = {"file_type": "docx", "file_name": path.rsplit("/", 1)[-1], "source": path, "page": 1, "pages": [1], "region": "body"}

    def add(text: str, heading: bool = False, kind: str = "text", where: str | None = None) -> None:
        out.append(base | {"element_type": kind, "text": text, "section": where or section, "is_heading": heading})

    def flush() -> None:
        if waiting:
            add("\n".join(waiting))
            waiting.clear()

    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        styles = _styles(archive)
        body = ElementTree.fromstring(archive.read("word/document.xml")).find(f"{_W}body")
        for node in body:
            if node.tag == f"{_W}p" and (text := _text(node)):
                if _is_heading(node, styles, text):
                    flush()
                    section = text
                    add(text, heading=True)
                else:
                    waiting.append(text)
            elif node.tag == f"{_W}tbl" and (found := read_grid(*_grid(node))) is not None:
                caption = None
                if waiting and len(waiting[-1]) <= SHORT:
                    caption = waiting.pop()
                elif not waiting and out and out[-1].get("is_heading"):
                    caption = out[-1]["text"]
                flush()
                last = out[-1] if out else None
                goes_on = last is not None and last["element_type"] == "table" and found["has_header"] and last["has_header"] and found["title"] is None and caption is None and [header_key(c) for c in last["columns"]] == [header_key(c) for c in found["columns"]]
                if goes_on:
                    last["rows"] += found["rows"]
                    last["merged_parts"] += 1
                    last["n_rows"] = len(last["rows"])
                else:
                    out.append(base | {"element_type": "table", "section": section, "is_heading": False, "title": found["title"] or caption or section or "Untitled table", "heading": caption, "has_header": found["has_header"], "columns": found["columns"], "headers": found["header_row"] or found["columns"], "rows": found["rows"], "n_rows": len(found["rows"]), "kind": "body", "merged_parts": 1})
        flush()
        if recognise is not None:
            for name in sorted(n for n in archive.namelist() if n.startswith("word/media/")):
                picture = archive.read(name)
                pixels = picture_pixels(picture)
                text = recognise(picture) if pixels is None or pixels >= PIXELS else ""
                if len(text) >= PICTURE_CHARS:
                    add(text, kind="ocr_text", where="Embedded image")
    for number, table in enumerate((e for e in out if e["element_type"] == "table"), 1):
        table["table_id"] = f"t{number:03d}"
    return out
