"""Text, number and date functions: Column in, Column out, no Python on the executors.

Regular expressions over free text use Unicode classes (``(?U)``), so ``\\s`` and ``\\d`` mean what
they mean to a reader rather than their ASCII parts. Nothing raises under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Literals that stand for "no value", words that an index leaves out, months, font
# names of bold type, numbers.
NULLISH = ("", "null", "none", "n/a", "na", "?", "-", "—", "–", "nan")
STOPWORDS = ("a", "an", "the", "and", "or", "of", "to", "in", "on", "for", "is", "are", "was", "were", "be", "by", "with", "as", "at", "it", "this", "that", "from", "all")
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
BOLD = r"(?i)bold|black|heavy|semibold"
NUMBER = r"^(?:[-+]?\d[\d,]*(?:\.\d+)?%?|[-+]?\.\d+%?)$"


def strip(x: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def clean_cell(x: Column) -> Column:
    """A cell on one line: null is empty, runs of blanks are one, line breaks are a blank."""
    flat = F.regexp_replace(F.coalesce(x.cast("string"), F.lit("")), " ", " ")
    flat = F.regexp_replace(flat, r"(?U)\s*\n\s*", " ")
    return strip(F.regexp_replace(flat, r"[ \t]{2,}", " "))


def norm_name(x: Column) -> Column:
    """A header as compared: lower case, other characters than letters and digits as one blank."""
    return F.trim(F.regexp_replace(F.lower(x), "[^a-z0-9]+", " "))


def is_number(x: Column) -> Column:
    return strip(x).rlike(NUMBER)


def is_null(x: Column) -> Column:
    return x.isNull() | F.lower(strip(x)).isin(*NULLISH)


def text_or_null(x: Column) -> Column:
    return F.when(~is_null(x), strip(x))


def _bare_number(x: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(strip(x), ",", ""), "%+$", "")
    return F.regexp_replace(bare, r"^\++", "")


def to_number(x: Column) -> Column:
    """``1,131``, ``24.6`` or ``+12.2%`` as a double; null if it is no number."""
    bare = _bare_number(x)
    return F.when(~is_null(x) & bare.rlike(r"^[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?$"), bare.try_cast("double"))


def number_is_int(x: Column) -> Column:
    """Whether a number was written as a whole one; null where there is none."""
    value = to_number(x)
    return F.when(value.isNotNull(), (value == F.floor(value)) & ~_bare_number(x).contains("."))


def _iso(y: Column, m: Column, d: Column) -> Column:
    y, m, d = (v.try_cast("int") for v in (y, m, d))
    made = F.try_to_date(F.format_string("%04d-%02d-%02d", y, m, d), "yyyy-MM-dd")
    return F.when((y >= 1) & m.between(1, 12) & d.between(1, 31), F.date_format(made, "yyyy-MM-dd"))


def parse_date(x: Column) -> Column:
    """Struct (iso, flag): an unambiguous date as ISO text, or why there is none."""
    t = strip(x)
    part = lambda pattern, i: F.regexp_extract(t, pattern, i)
    # The ways that dates are written.
    year_first = r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})$"
    day_name = r"^(\d{1,2})\s+([A-Za-z]{3,9})\.?,?\s+(\d{4})$"
    name_day = r"^([A-Za-z]{3,9})\.?\s+(\d{1,2}),?\s+(\d{4})$"
    no_year = r"^([A-Za-z]{3,9})\.?\s+\d{1,2}$"
    numeric = r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{2,4})$"
    month = lambda c: F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.substring(c, 1, 3)))
    known = lambda pattern, i: t.rlike(pattern) & (month(part(pattern, i)) > 0)
    a, b, y = (part(numeric, i).try_cast("int") for i in (1, 2, 3))
    y = F.when(y < 100, y + 2000).otherwise(y)
    dated = lambda iso: F.struct(iso.alias("iso"), F.when(iso.isNull(), "date_invalid").alias("flag"))
    flagged = lambda flag: F.struct(F.lit(None).cast("string").alias("iso"), F.lit(flag).cast("string").alias("flag"))
    return (
        F.when(is_null(x), flagged(None))
        .when(t.rlike(year_first), dated(_iso(part(year_first, 1), part(year_first, 2), part(year_first, 3))))
        .when(known(day_name, 2), dated(_iso(part(day_name, 3), month(part(day_name, 2)), part(day_name, 1))))
        .when(known(name_day, 1), dated(_iso(part(name_day, 3), month(part(name_day, 1)), part(name_day, 2))))
        .when(known(no_year, 1), flagged("date_missing_year"))
        .when(t.rlike(numeric) & (a > 12) & (b <= 12), dated(_iso(y, b, a)))
        .when(t.rlike(numeric) & (b > 12) & (a <= 12), dated(_iso(y, a, b)))
        .when(t.rlike(numeric) & (a == b), dated(_iso(y, a, b)))
        .when(t.rlike(numeric), flagged("date_ambiguous"))
        .otherwise(flagged("date_unparsed"))
    )


def line_signature(line: Column) -> Column:
    """A line without its numbers, so that page numbers make no difference."""
    return F.regexp_replace(F.lower(strip(line)), r"(?U)\d+", "#")


# A line that is a page's number, and what index terms and sentences are.
PAGE_NUMBER = r"(?iU)^\s*(?:page\s*)?\d+(?:\s*(?:/|of)\s*\d+)?\s*$"
TERM, TERM_PARTS = r"[a-z0-9]+(?:[-_./][a-z0-9]+)*", "[-_./]"
SENTENCE_ENDS = r"(?U)(?<=[.!?;])\s+|\n+"


def is_page_number(line: Column) -> Column:
    return line.rlike(PAGE_NUMBER)


def plain_text(x: Column) -> Column:
    """Line ends as ``\\n``, tabs as blanks, words put together that a line break had cut."""
    flat = F.regexp_replace(F.regexp_replace(x, r"\r\n?", "\n"), "\t", " ")
    return F.regexp_replace(flat, r"([a-z])-\n([a-z])", "$1$2")


def clean_line(line: Column) -> Column:
    return strip(F.regexp_replace(line, " {2,}", " "))


def unmapped_glyphs(x: Column) -> Column:
    """PDF glyph codes: the bullet's as a bullet, others dropped."""
    return F.regexp_replace(F.regexp_replace(x, r"\(cid:127\)", "•"), r"\(cid:\d+\)", "")


def tidy(x: Column) -> Column:
    """Recognised text: blanks of each line squeezed, blank lines dropped."""
    lines = F.transform(F.split(x, "\n"), lambda line: strip(F.regexp_replace(line, r"[ \t]+", " ")))
    return F.array_join(F.filter(lines, lambda line: line != ""), "\n")


def tokens(x: Column) -> Column:
    """Index terms: compounds such as ``r-1841-a`` and also their parts, without stop words."""
    found = F.regexp_extract_all(F.lower(x), F.lit(TERM), F.lit(0))
    joined = lambda t: t.contains("-") | t.contains(".") | t.contains("/") | t.contains("_")
    parts = F.flatten(F.transform(found, lambda t: F.when(joined(t), F.concat(F.array(t), F.split(t, TERM_PARTS))).otherwise(F.array(t))))
    return F.filter(parts, lambda t: ~t.isin(*STOPWORDS))


def token_cost(x: Column) -> Column:
    """Estimated word pieces: runs of letters or digits cost one for each 3.2 characters begun."""
    found = F.regexp_extract_all(x, F.lit(r"(?U)[A-Za-z]+|\d+|[^\w\s]"), F.lit(0))
    return F.coalesce(F.aggregate(found, F.lit(0).cast("bigint"), lambda n, t: n + F.greatest(F.lit(1), F.ceil(F.length(t) / 3.2)).cast("bigint")), F.lit(0).cast("bigint"))


def sentences(x: Column) -> Column:
    return F.filter(F.split(x, SENTENCE_ENDS), lambda s: strip(s) != "")


def ground_form(x: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(x), "[^a-z0-9@+.]+", " "))


def grounded(value: Column, source: Column) -> Column:
    """Whether a value stands in the source, whatever the blanks and punctuation; empty ones do."""
    return value.isNull() | (value == "") | ground_form(source).contains(ground_form(value))


def without_preamble(x: Column) -> Column:
    """A chunk's text without the lines on where it comes from."""
    return F.regexp_replace(x, r"^(?:(?:Section:|Pages:|Sheet:|\(text recognised)[^\n]*(?:\n|$))+", "")


def citation(title: Column, section: Column, pages: Column) -> Column:
    first, last = F.element_at(pages, 1).cast("string"), F.element_at(pages, -1).cast("string")
    where = F.when(F.size(F.array_distinct(pages)) == 1, first).otherwise(F.concat_ws("-", first, last))
    name = F.coalesce(F.nullif(title, F.lit("")), F.nullif(section, F.lit("")), F.lit("text"))
    return F.concat(F.lit("["), name, F.lit(", p."), where, F.lit("]"))


def display_title(title: Column, heading: Column, section: Column) -> Column:
    filled = [F.nullif(c, F.lit("")) for c in (title, heading, section)]
    return F.coalesce(*filled, F.lit("Untitled table"))


def column_letters(n: Column) -> Column:
    """Spreadsheet letters of a column number (up to three letters)."""
    n = n.cast("int")
    letter = lambda k: F.char(k + 65)
    low, mid, high = (n - 1) % 26, F.floor((n - 27) / 26) % 26, F.floor((n - 703) / 676) % 26
    return F.concat(F.when(n > 702, letter(high)).otherwise(""), F.when(n > 26, letter(mid)).otherwise(""), letter(low))


def block_range(sheet: Column, row_low: Column, row_high: Column, col_low: Column, col_high: Column) -> Column:
    name = F.replace(sheet, F.lit("'"), F.lit("''"))
    name = F.when(sheet.rlike("[^A-Za-z0-9_]"), F.concat(F.lit("'"), name, F.lit("'"))).otherwise(name)
    return F.concat(name, F.lit("!"), column_letters(col_low), row_low.cast("string"), F.lit(":"), column_letters(col_high), row_high.cast("string"))


def file_kind(path: Column) -> Column:
    """The loader of a path's suffix, or null if there is none."""
    suffix = F.lower(F.regexp_extract(path, r"(\.[^./\\]+)$", 1))
    return F.when(suffix == ".pdf", "pdf").when(suffix.isin(".xlsx", ".xlsm"), "xlsx").when(suffix == ".docx", "docx").when(suffix == ".doc", "doc").when(suffix == ".xls", "xls")
