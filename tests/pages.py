"""Stand-ins for a PDF library's pages, out of words with places."""

import types


class Page:
    """Words are (text, x0, top, options); a character is as wide as 0.6 of its size."""

    def __init__(self, words=(), tables=(), images=(), width=600, height=800, name="page", chars=None):
        self.width, self.height, self.images, self.name = width, height, list(images), name
        self._tables = list(tables)
        self.chars = chars if chars is not None else [c for n, w in enumerate(words) for c in self._letters(n, *w)]

    @staticmethod
    def _letters(word, text, x0, top, size=10, bold=False, upright=True, matrix=None):
        for k, letter in enumerate(text):
            x = x0 + (k * 0.6 * size if upright else 0)
            y = top + (0 if upright else k * size)
            yield {"object_type": "char", "text": letter, "x0": x, "x1": x + 0.6 * size, "top": y, "bottom": y + size, "size": size, "upright": upright, "fontname": "Some-Bold" if bold else "Some", "word": word, "matrix": matrix or ((1, 0, 0, 1, x, y) if upright else (0, 1, -1, 0, x, y))}

    def filter(self, keep):
        return Page(width=self.width, height=self.height, name=self.name, chars=[c for c in self.chars if keep(c)])

    def _words(self):
        by = {}
        for c in self.chars:
            by.setdefault(c["word"], []).append(c)
        return [{"text": "".join(c["text"] for c in w), "x0": min(c["x0"] for c in w), "x1": max(c["x1"] for c in w), "top": min(c["top"] for c in w), "bottom": max(c["bottom"] for c in w), "size": w[0]["size"], "chars": w} for w in by.values()]

    def extract_words(self, **options):
        return self._words()

    def extract_text_lines(self, **options):
        lines = {}
        for w in sorted(self._words(), key=lambda w: (w["top"], w["x0"])):
            lines.setdefault(w["top"], []).append(w)
        for line in lines.values():
            blank = [{**a["chars"][-1], "text": " ", "x0": a["x1"], "x1": min(a["x1"] + 3, b["x0"])} for a, b in zip(line, line[1:])]
            chars = [c for k, w in enumerate(line) for c in w["chars"] + blank[k : k + 1]]
            yield {"text": " ".join(w["text"] for w in line), "x0": line[0]["x0"], "x1": line[-1]["x1"], "top": min(w["top"] for w in line), "bottom": max(w["bottom"] for w in line), "chars": chars}

    def find_tables(self, table_settings):
        assert table_settings["snap_tolerance"] == 3
        if isinstance(self._tables, list) and self._tables == ["broken"]:
            raise ValueError("no tables here")
        return self._tables

    def crop(self, box):
        return Page(width=box[2] - box[0], height=box[3] - box[1], name=f"{self.name} at {box[0]}")

    def to_image(self, resolution):
        return types.SimpleNamespace(original=types.SimpleNamespace(save=lambda to, kind: to.write(self.name.encode())))


def ruled(x0, top, grid, width=80, height=20):
    """A table of equal cells with its top left corner at a place; None is a merged cell."""
    rows = [types.SimpleNamespace(cells=[None if v is None else (x0 + k * width, top + i * height, x0 + (k + 1) * width, top + (i + 1) * height) for k, v in enumerate(row)]) for i, row in enumerate(grid)]
    return types.SimpleNamespace(bbox=(x0, top, x0 + width * len(grid[0]), top + height * len(grid)), rows=rows, extract=lambda: [list(r) for r in grid])


def words(text, x0, top, **options):
    """A line of words."""
    out, x = [], x0
    for w in text.split():
        out.append((w, x, top, *[options.get(k, d) for k, d in (("size", 10), ("bold", False), ("upright", True), ("matrix", None))]))
        x += 6 * len(w) + 4
    return out
