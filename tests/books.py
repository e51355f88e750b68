"""Small office files made with the standard library."""

import io
import zipfile
from xml.sax.saxutils import escape

from sheafmill.sources.excel import column_letters

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
DATE, PERCENT = 1, 2


def workbook(sheets):
    """``sheets`` is {name: (cells, merged)}; a cell is a text, a number, ("=formula",) or (number, style)."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        names = "".join(f'<sheet name="{escape(n)}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f"<workbook {MAIN}><sheets>{names}</sheets></workbook>")
        links = "".join(f'<Relationship Id="rId{i}" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{links}</Relationships>')
        z.writestr("xl/styles.xml", f'<styleSheet {MAIN}><cellXfs count="3"><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="10"/></cellXfs></styleSheet>')
        for i, (cells, merged) in enumerate(sheets.values(), 1):
            rows = ""
            for (r, c), v in sorted(cells.items()):
                at = f"{column_letters(c)}{r}"
                if isinstance(v, str):
                    body = f'<c r="{at}" t="inlineStr"><is><t>{escape(v)}</t></is></c>'
                elif isinstance(v, tuple) and len(v) == 1:
                    body = f'<c r="{at}"><f>{escape(v[0][1:])}</f></c>'
                elif isinstance(v, tuple):
                    body = f'<c r="{at}" s="{v[1]}"><v>{v[0]}</v></c>'
                else:
                    body = f'<c r="{at}"><v>{v}</v></c>'
                rows += f'<row r="{r}">{body}</row>'
            spans = "".join(f'<mergeCell ref="{m}"/>' for m in merged)
            z.writestr(f"xl/worksheets/sheet{i}.xml", f"<worksheet {MAIN}><sheetData>{rows}</sheetData>" + (f"<mergeCells>{spans}</mergeCells>" if merged else "") + "</worksheet>")
    return out.getvalue()


def grid(rows, top=1, left=1):
    return {(top + i, left + j): v for i, row in enumerate(rows) for j, v in enumerate(row) if v is not None}


W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'


def document(parts):
    """Parts: ("h", text), ("p", text), ("b", text) for a bold paragraph, ("t", rows)."""
    body = ""
    for kind, x in parts:
        if kind == "t":
            body += "<w:tbl>" + "".join("<w:tr>" + "".join(f"<w:tc><w:p><w:r><w:t>{escape(c)}</w:t></w:r></w:p></w:tc>" for c in row) + "</w:tr>" for row in x) + "</w:tbl>"
        else:
            style = '<w:pPr><w:pStyle w:val="Heading1"/></w:pPr>' if kind == "h" else ""
            bold = "<w:rPr><w:b/></w:rPr>" if kind == "b" else ""
            body += f"<w:p>{style}<w:r>{bold}<w:t>{escape(x)}</w:t></w:r></w:p>"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {W}><w:body>{body}</w:body></w:document>")
    return out.getvalue()
