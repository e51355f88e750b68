"""Secret scan: known formats, and strings of high sliding-window entropy.

All of it is built-in column expressions: no Python runs on the executors, and no row leaves its
partition. A regular expression's matches get positions from ``split`` and ``regexp_extract_all``:
the pieces between matches and the matches alternate, so prefix sums of their lengths place them.

Base spans are ``assign`` (a password-like name, ``=`` or ``:``, a value of 12+ characters),
``access`` (``AKIA`` and more, 18+ characters) and ``hex`` (16+ lower-case hex digits). ``entropy``
spans come on top: a candidate is a run of key characters; over its windows of ``WINDOW``
characters the Shannon entropy is kept up to date by counts, adding the character that enters and
removing the one that leaves; it is a secret if the largest is at least its character class'
threshold. The allow-list suppresses entropy spans only, as does any overlap with a base span.

Defined cases: a null text is empty and has no span; positions are code points, ends exclusive;
the work grows near linearly in a text's length, in the length of a candidate and in the number
of matches, and no pattern recurses on what it reads; ids may be null or repeat (each row gives
a row); an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: Characters of a window.
WINDOW = 20
#: (class, what it matches, least entropy of its best window in bits); the first that matches holds.
#: A threshold above log2(WINDOW) can't be reached: strings of digits alone are no candidates. Those
#: of letters alone are often words, so nearly all characters of a window must differ.
NEVER = 99.0
CLASSES = (
    ("digits", r"^[0-9_/=+-]+$", NEVER),
    ("letters", r"^[A-Za-z_/=+-]+$", 4.1),
    ("hex", r"^[0-9a-fA-F]+$", 3.0),
    ("upper", r"^[A-Z0-9]+$", 3.4),
    ("lower", r"^[a-z0-9]+$", 3.4),
    ("alnum", r"^[A-Za-z0-9]+$", 3.6),
    ("base64", r"^.+$", 3.8),
)
#: A candidate that matches one of these is no secret: an identifier, a placeholder, a path or a slug.
#: Repeated groups are possessive: the engine then loops where it would recurse, and what they
#: match is the same, as each part can only end in one place.
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"(?i:example|placeholder|changeme|dummy|xxxx|0123456789|deadbeef)",
    r"^/?[a-z]++[0-9]{0,4}+(?:/[a-z]++[0-9]{0,4}+)++/?$",
    r"^[a-z]++(?:[-_][a-z0-9]{1,12}+){2,}+$",
)
KINDS = ("assign", "access", "hex", "entropy")

_STRIDE = 256
#: Windows of a piece in which counts are kept, and of a chunk that is cut into pieces.
_PIECE, _CHUNK = 64, 4096
#: Code of the first key character; characters whose counts share a number, bits of each, and numbers.
_FIRST, _EACH, _BITS = ord("+"), 12, 5
_NUMBERS = -(-(ord("z") - _FIRST + 1) // _EACH)


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, x: a + x)


def with_matches(rows: DataFrame, text: str, patterns: dict[str, tuple[str, int]]) -> DataFrame:
    """Adds, by name, structs (start, end, value) of a pattern's matches; ``value`` is the given group.

    Every array is a column before a lambda reads it: what a lambda refers to is worked out anew
    for each element otherwise. Sums before each match are taken in strides, so the work stays
    near linear in the matches.
    """
    c = lambda k, n: F.col(f"{n}__{k}")
    none = F.array().cast("array<string>")

    def whole(n: str) -> Column:
        return F.when(F.col(text).rlike(patterns[n][0]), F.regexp_extract_all(text, F.lit(patterns[n][0]), F.lit(0))).otherwise(none)

    def value(n: str) -> Column:
        group = patterns[n][1]
        return F.when(F.size(c("whole", n)) > 0, F.regexp_extract_all(text, F.lit(patterns[n][0]), F.lit(group))).otherwise(none) if group else c("whole", n)

    def gap(n: str) -> Column:
        between = F.when(F.size(c("whole", n)) > 0, F.split(text, patterns[n][0], -1)).otherwise(none)
        return F.slice(F.transform(between, F.length), 1, F.size(c("whole", n)))

    def reach(n: str) -> Column:
        return F.zip_with(c("gap", n), c("whole", n), lambda g, w: g + F.length(w))

    def parts(n: str) -> Column:
        places = F.sequence(F.lit(0), F.floor((F.size(c("reach", n)) - 1) / _STRIDE).cast("int"))
        return F.when(F.size(c("reach", n)) > 0, F.transform(places, lambda s: F.slice(c("reach", n), s * _STRIDE + 1, _STRIDE))).otherwise(F.array().cast("array<array<int>>"))

    def sums(n: str) -> Column:
        return F.transform(c("parts", n), _sum)

    def bases(n: str) -> Column:
        return F.transform(c("sums", n), lambda _, i: _sum(F.slice(c("sums", n), 1, i)))

    def before(n: str) -> Column:
        return F.flatten(F.zip_with(c("parts", n), c("bases", n), lambda part, base: F.transform(part, lambda _, i: base + _sum(F.slice(part, 1, i)))))

    def start(n: str) -> Column:
        return F.zip_with(c("before", n), c("gap", n), lambda x, g: x + g)

    def both(n: str) -> Column:
        return F.zip_with(c("whole", n), c("value", n), lambda w, v: F.struct(F.length(w).alias("w"), v.alias("v")))

    stages = (whole, value, gap, reach, parts, sums, bases, before, start, both)
    out = rows
    for make in stages:
        out = out.withColumns({f"{n}__{make.__name__}": make(n) for n in patterns})
    spans = {n: F.zip_with(c("start", n), c("both", n), lambda s, x: F.struct(s.alias("start"), (s + x["w"]).alias("end"), x["v"].alias("value"))) for n in patterns}
    return out.withColumns(spans).drop(*[f"{n}__{make.__name__}" for n in patterns for make in stages])


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once, however often a lambda in it reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def best_entropy(value: Column, window: int = WINDOW) -> Column:
    """The largest Shannon entropy, in bits, of a window of the string (at least that long).

    The string is cut into chunks and these into pieces that overlap by a window less one
    character, so no step handles more than a piece. A window's counts are packed into a few
    numbers, ``_BITS`` bits each: entering and leaving characters add and take away one bit there.
    """
    weight = F.array(*[F.lit(c * log2(c) if c else 0.0) for c in range(window + 2)])
    shift = lambda name, x, by: F.call_function(name, x, by)

    def cut(text: Column, stride: int) -> Column:
        return F.transform(F.sequence(F.lit(0), F.length(text) - window, F.lit(stride)), lambda s: F.substr(text, s + 1, F.lit(stride + window - 1)))

    def place(ch: Column) -> Column:
        code = F.ascii(ch) - _FIRST
        return F.struct((code / _EACH).cast("int").alias("number"), (code % _EACH * _BITS).alias("bit"))

    def count(counts: Column, at: Column) -> Column:
        return shift("shiftright", F.get(counts, at["number"]), at["bit"]).bitwiseAND(F.lit((1 << _BITS) - 1)).cast("int")

    def step(state: Column, pair: Column) -> Column:
        enters, leaves = pair["enters"], pair["leaves"]
        n, m = count(state["counts"], enters), F.coalesce(count(state["counts"], leaves), F.lit(0))
        moved = F.get(weight, n + 1) - F.get(weight, n) - F.when(leaves.isNotNull(), F.get(weight, m) - F.get(weight, m - 1)).otherwise(0.0)
        s = state["s"] + F.when(F.coalesce(leaves == enters, F.lit(False)), 0.0).otherwise(moved)
        one = lambda at, j: F.when(at["number"] == j, shift("shiftleft", F.lit(1).cast("long"), at["bit"])).otherwise(F.lit(0).cast("long"))
        counts = F.transform(state["counts"], lambda c, j: c + one(enters, j) - one(leaves, j))
        bits = F.when(state["n"] >= window - 1, F.lit(log2(window)) - s / window).otherwise(0.0)
        return F.struct(counts.alias("counts"), (state["n"] + 1).alias("n"), s.alias("s"), F.greatest(state["best"], bits).alias("best"))

    def best(piece: Column) -> Column:
        places = F.transform(F.filter(F.split(piece, ""), lambda ch: ch != ""), place)
        pairs = _let(places, lambda p: F.transform(p, lambda x, i: F.struct(x.alias("enters"), F.get(p, i - window).alias("leaves"))))
        start = F.struct(F.array_repeat(F.lit(0).cast("long"), _NUMBERS).alias("counts"), F.lit(0).alias("n"), F.lit(0.0).alias("s"), F.lit(0.0).alias("best"))
        return F.aggregate(pairs, start, step, lambda x: x["best"])

    return F.array_max(F.transform(cut(value, _CHUNK), lambda chunk: F.array_max(F.transform(cut(chunk, _PIECE), best))))


def least_entropy(value: Column, classes=CLASSES) -> Column:
    out = F.lit(NEVER)
    for _, pattern, least in reversed(classes):
        out = F.when(value.rlike(pattern), F.lit(least)).otherwise(out)
    return out


def overlaps(span: Column, starts: Column, ends: Column) -> Column:
    """Whether a span meets one of disjoint spans, given in order by their starts and ends.

    How many of them start before its end is found by halving; the last of these reaches farthest.
    """
    powers = F.array(*[F.lit(1 << k) for k in range(24, -1, -1)])
    before = F.aggregate(powers, F.lit(0), lambda n, step: F.when(F.coalesce(F.get(starts, n + step - 1) < span["end"], F.lit(False)), n + step).otherwise(n))
    return F.when(F.size(starts) == 0, False).otherwise(F.coalesce(F.get(ends, before - 1) > span["start"], F.lit(False)))


def _kind(spans: Column, number: int) -> Column:
    return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), F.lit(number).alias("kind"), x["end"].alias("end")))


def written(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", names[x["kind"]], x["start"].cast("string"), x["end"].cast("string"))), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", classes=CLASSES, allowed=ALLOWED) -> DataFrame:
    """A row for each row of ``docs``: doc_id, ``base`` and ``added`` spans (start, kind, end), kinds numbered as in KINDS."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    field = lambda e: lambda x: x[e]
    found = with_matches(rows, "t", {"a": (ASSIGN, 2), "k": (ACCESS, 0), "h": (HEX, 0), "c": (CANDIDATE, 0)})
    found = found.select("doc_id", F.filter("a", lambda x: F.length(x["value"]) >= 12).alias("a"), "k", "h", "c")
    # Not ``a.start``: the optimiser would take that apart anew wherever a lambda reads it.
    found = found.select("*", *[F.transform(n, field(e)).alias(f"{n}_{e}") for n in "akh" for e in ("start", "end")])
    base = F.concat(_kind(F.col("a"), 0), _kind(F.col("k"), 1), _kind(F.col("h"), 2))
    met = lambda x: overlaps(x, F.col("a_start"), F.col("a_end")) | overlaps(x, F.col("k_start"), F.col("k_end")) | overlaps(x, F.col("h_start"), F.col("h_end"))
    suppressed = "|".join(f"(?:{p})" for p in allowed)
    clear = F.filter("c", lambda x: ~met(x) & ~x["value"].rlike(suppressed))
    found = found.select("doc_id", base.alias("base"), clear.alias("c"))
    graded = F.filter(F.transform("c", lambda x: x.withField("least", least_entropy(x["value"], classes))), lambda x: x["least"] < NEVER)
    added = _kind(F.filter(graded, lambda x: best_entropy(x["value"]) >= x["least"]), 3)
    return found.select("doc_id", "base", added.alias("added"))
