"""Text scalar functions as Column expressions.

All are built-in ``regexp_*``/string expressions, so they run inside
whole-stage codegen; none needs a Python worker.

Python's ``re`` treats ``\\s`` as Unicode whitespace including U+001C..U+001F
and ``str.strip()`` strips the same set; Java's ``\\s`` is ASCII-only, so the
patterns below use ``(?U)`` plus an explicit ``\\x1c-\\x1f`` range.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import PROMPT_TEMPLATE

# Python whitespace as a Java character class.
WS = r"[\s\x1c-\x1f]"
WS_RUN = r"(?U)" + WS + "+"
# Every character Python's ``str.isspace`` accepts (the same set
# as Java's White_Space property plus U+001C..U+001F), for set-based trims.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)
LATEX_WRAP = r"\\[a-z]+\{([^}]*)\}"
URL_PATTERN = r"(?U)https?://[^\s\x1c-\x1f]+"
ASCII_KEY_DROP = r"[^a-zA-Z0-9]"
UNICODE_KEY_DROP = r"[^\p{L}\p{N}]"

# Venue keyword -> decision, first match wins.
VENUE_DECISIONS = [
    ("oral", "Accepted(Oral)"),
    ("spotlight", "Accepted(Spotlight)"),
    ("poster", "Accepted(Poster)"),
    ("withdrawn", "Withdrawn"),
    ("desk rejected", "Desk Rejected"),
    ("submitted", "Rejected"),
]
VENUE_FALLBACK = "None"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def py_strip(x: Column | str) -> Column:
    """``str.strip()``: remove leading/trailing Unicode whitespace.

    A character-set trim touches only the ends of the string (a regex with a
    trailing anchor would be tried at every whitespace run of the text)."""
    return F.trim(_c(x), F.lit(PY_WHITESPACE))


def normalize_text(x: Column | str) -> Column:
    """H1: lower, unwrap ``\\cmd{x}`` once, mask URLs, newlines to spaces,
    collapse whitespace runs, strip. Lower-casing comes first, so the mask is
    the upper-case token ``URL`` and only lower-case schemes are seen."""
    t = F.lower(_c(x))
    t = F.regexp_replace(t, LATEX_WRAP, "$1")
    t = F.regexp_replace(t, URL_PATTERN, "URL")
    t = F.replace(t, F.lit("\n"), F.lit(" "))
    t = F.regexp_replace(t, WS_RUN, " ")
    return F.trim(t)  # after the collapse every whitespace run is one space


def title_key(x: Column | str, unicode_key: bool = False) -> Column:
    """H2: keep ASCII letters and digits, lower-case. ``unicode_key`` keeps
    every letter/number instead, so non-Latin titles do not all collapse to
    the empty key."""
    drop = UNICODE_KEY_DROP if unicode_key else ASCII_KEY_DROP
    return F.lower(F.regexp_replace(_c(x), drop, ""))


def venue_decision(venue: Column | str) -> Column:
    """H3: venue string -> decision; NULL stays NULL (a reject upstream)."""
    v = F.lower(_c(venue))
    expr = None
    for needle, label in VENUE_DECISIONS:
        cond = v.contains(needle)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.when(_c(venue).isNull(), F.lit(None).cast("string")).otherwise(expr.otherwise(F.lit(VENUE_FALLBACK)))


def year_from_label(x: Column | str) -> Column:
    """H4: two-digit year from ``AAAI-NN`` first, else from ``20NN``."""
    x = _c(x)
    first = F.nullif(F.regexp_extract(x, r"AAAI-([0-9]{2})", 1), F.lit(""))
    second = F.nullif(F.regexp_extract(x, r"20([0-9]{2})", 1), F.lit(""))
    return F.coalesce(first, second).cast("int")


def year_route(year: Column, target: int) -> Column:
    """Unknown or equal year -> process, later -> skip, earlier -> stop."""
    t = F.lit(target)
    return (
        F.when(year.isNull(), F.lit("process"))
        .when(year == t, F.lit("process"))
        .when(year > t, F.lit("skip"))
        .otherwise(F.lit("stop"))
    )


def abstract_cleanup(x: Column | str) -> Column:
    """H5: ``\\s{2,}`` -> one space, drop every ``Abstract:``, newline ->
    space, strip; in that order (a lone newline survives the first step)."""
    t = F.regexp_replace(_c(x), r"(?U)" + WS + "{2,}", " ")
    t = F.replace(t, F.lit("Abstract:"), F.lit(""))
    t = F.replace(t, F.lit("\n"), F.lit(" "))
    return py_strip(t)


def strip_label_prefix(section_text: Column | str, div_text: Column | str | None = None) -> Column:
    """H6: inner ``div`` text (stripped) when present, else the section text
    stripped, with one leading ``Abstract`` removed and stripped again."""
    sec = py_strip(section_text)
    sec = F.when(sec.startswith("Abstract"), py_strip(F.substring(sec, len("Abstract") + 1, 1 << 30))).otherwise(sec)
    if div_text is None:
        return sec
    return F.coalesce(py_strip(div_text), sec)


def conference_info(venue_id: Column | str) -> Column:
    """``ICLR.cc/2024/Conference`` -> ``iclr_2024``; else ``openreview``."""
    parts = F.split(_c(venue_id), "/", -1)
    conf = F.lower(F.element_at(F.split(F.element_at(parts, 1), r"\.", -1), 1))
    return F.when(F.size(parts) >= 2, F.concat(conf, F.lit("_"), F.element_at(parts, 2))).otherwise(
        F.lit("openreview")
    )


def venue_id(conference: Column | str, yy: Column | str) -> Column:
    """``{conf}.cc/20{yy}/Conference``."""
    return F.concat(_c(conference), F.lit(".cc/20"), _c(yy).cast("string"), F.lit("/Conference"))


def listing_url(conference: Column | str, yy: Column | str, base: str) -> Column:
    """Conference listing page ``{base}{conference}20{yy}?day=all``
    (the conference name as given; every conference gets a URL)."""
    return F.concat(F.lit(base), _c(conference), F.lit("20"), _c(yy).cast("string"), F.lit("?day=all"))


def absolute_url(prefix: str, link: Column | str) -> Column:
    """Constant prefix + relative link."""
    return F.concat(F.lit(prefix), _c(link))


def forum_url(note_id: Column | str, base: str = "https://openreview.net/forum?id=") -> Column:
    """Note id -> forum URL."""
    return F.concat(F.lit(base), _c(note_id))


def paper_text(title: Column | str, abstract: Column | str) -> Column:
    """B1: ``title + ": " + abstract`` (NULL if either is NULL)."""
    return F.concat(_c(title), F.lit(": "), _c(abstract))


def prompt_text(title: Column | str, abstract: Column | str, template: str = PROMPT_TEMPLATE) -> Column:
    """B2: fill the instruction template with (normalised) title and abstract."""
    head, rest = template.split("{title}")
    mid, tail = rest.split("{abstract}")
    return F.concat(F.lit(head), _c(title), F.lit(mid), _c(abstract), F.lit(tail))


def snippet(x: Column | str, n: int = 100) -> Column:
    """First ``n`` code points followed by ``...``."""
    return F.concat(F.substring(_c(x), 1, n), F.lit("..."))


_SPLIT = 134217729.0  # 2**27 + 1, Veltkamp splitting constant


def fmt_fixed(x: Column | str, decimals: int = 4) -> Column:
    """``f"{x:.Nf}"`` exactly, for finite doubles below about 1e11.

    Java's ``%.4f`` rounds half-up on the shortest decimal form of the double
    (0.55555 -> 0.5556), Python rounds the exact binary value half-to-even
    (0.55555 is 0.555549999... -> 0.5555). Here ``x * 10**N`` is computed
    with its exact rounding error (an error-free product by Veltkamp
    splitting), so the distance to the rounding midpoint has the right sign;
    exact ties go to the even neighbour. All in double arithmetic (JVM)."""
    x = _c(x).cast("double")
    scale = float(10**decimals)
    p = x * F.lit(scale)
    c = F.lit(_SPLIT) * x
    hi = c - (c - x)
    lo = x - hi
    err = (hi * F.lit(scale) - p) + lo * F.lit(scale)  # p + err == x * scale exactly
    n = F.floor(p).cast("double")
    t = (p - n - F.lit(0.5)) + err  # sign of (exact fraction - 1/2)
    n_long = n.cast("long")
    even = F.pmod(n_long, F.lit(2)) == 0
    k = F.when(t > 0, n_long + 1).when(t < 0, n_long).when(even, n_long).otherwise(n_long + 1)
    mag = F.abs(k)
    unit = F.lit(10**decimals)
    body = F.concat(
        (mag / unit).cast("long").cast("string"),  # integer part
        F.lit("."),
        F.lpad(F.pmod(mag, unit).cast("string"), decimals, "0"),
    )
    # negative values that round to zero, and -0.0 itself, keep their sign
    negative = x.cast("string").startswith("-")
    sign = F.when((k < 0) | ((k == 0) & negative), F.lit("-")).otherwise(F.lit(""))
    return (
        F.when(x.isNull(), F.lit(None).cast("string"))
        .when(F.isnan(x), F.lit("nan"))
        .when(x == F.lit(float("inf")), F.lit("inf"))
        .when(x == F.lit(float("-inf")), F.lit("-inf"))
        .otherwise(F.concat(sign, body))
    )


def fmt4(x: Column | str) -> Column:
    """Four decimals, as Python's ``f"{x:.4f}"``."""
    return fmt_fixed(x, 4)


def first_line(x: Column | str) -> Column:
    """Title of a document: text before the first newline."""
    return F.substring_index(_c(x), "\n", 1)


def after_first_line(x: Column | str) -> Column:
    """Abstract of a document: text after the first newline; NULL if none."""
    x = _c(x)
    pos = F.instr(x, "\n")
    return F.when(pos > 0, x.substr(pos + F.lit(1), F.lit(1 << 30)))
