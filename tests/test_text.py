import pytest
from pyspark.sql import functions as F

from papertriage.functions import text as TX

# (input, expected) unit rows, expected values derived by hand from the
# documented steps: lower, unwrap one \cmd{...}, mask URLs, newlines to
# spaces, collapse whitespace, strip
NORMALIZE_ROWS = [
    ("\\textbf{R}obust Models", "robust models"),
    ("\\href{a}{b}", "a{b}"),  # one non-recursive pass
    ("\\emph{a {nested} b}", "a {nested b}"),
    ("\\textit{line\nbreak} tail", "line break tail"),
    ("See \\url{https://a.b/C} end.", "see URL end."),  # lower-cased before masking
    ("HTTPS://X.Y/z, ok", "URL ok"),
    ("https://x.y/a?b=c and http://q.r", "URL and URL"),
    ("a\u00a0b\u2003c\u001cd\u0085e\u3000f", "a b c d e f"),
    ("\u0130stanbul Stra\u00dfe", "i\u0307stanbul stra\u00dfe"),
    ("  multiple   spaces\t\tand\nnewlines  ", "multiple spaces and newlines"),
    ("", ""),
    ("\u03a3\u039f\u03a3 final sigma", "\u03c3\u03bf\u03c2 final sigma"),
]


def _one(spark, rows, fn):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, s string")
    return [r["o"] for r in df.select("i", fn(F.col("s")).alias("o")).orderBy("i").collect()]


def test_normalize_unit_rows(spark):
    assert _one(spark, [r for r, _ in NORMALIZE_ROWS], TX.normalize_text) == [e for _, e in NORMALIZE_ROWS]


def test_py_strip_matches_str_strip(spark):
    rows = ["  a  ", "\u3000\u2003x\u0085\u00a0", "\x1c\x1dy\x1e\x1f", "", "   ", "in ner"]
    assert _one(spark, rows, TX.py_strip) == [r.strip() for r in rows]


def test_whitespace_set_is_pythons():
    allws = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())
    assert sorted(allws) == sorted(TX.PY_WHITESPACE)


TITLE_ROWS = ["Deep-Learning: A Survey!", "!!!", "\ud55c\uad6d\uc5b4 \uc81c\ubaa9", "R\u00e9sum\u00e9 na\u00efve 42"]


def test_title_key(spark):
    assert _one(spark, TITLE_ROWS, TX.title_key) == ["deeplearningasurvey", "", "", "rsumnave42"]
    # Korean-only title -> empty key (ASCII mode); Unicode mode keeps letters
    uni = _one(spark, TITLE_ROWS, lambda c: TX.title_key(c, unicode_key=True))
    assert uni[2] == "\ud55c\uad6d\uc5b4\uc81c\ubaa9"
    assert uni[3] == "r\u00e9sum\u00e9na\u00efve42"


def test_venue_decision(spark):
    rows = ["ICLR 2024 oral", "Spotlight", "poster session", "Withdrawn Submission", "Desk Rejected Submission",
            "Submitted to ICLR", "", None, "Oral Poster"]
    got = _one(spark, rows, TX.venue_decision)
    assert got == ["Accepted(Oral)", "Accepted(Spotlight)", "Accepted(Poster)", "Withdrawn", "Desk Rejected",
                   "Rejected", "None", None, "Accepted(Oral)"]


@pytest.mark.parametrize(
    "label,year",
    [("AAAI-24 Technical Tracks 1", 24), ("Vol. 38 (2024)", 24), ("AAAI-2024 T", 20), ("no year", None), (None, None)],
)
def test_year_from_label(spark, label, year):
    assert _one(spark, [label], TX.year_from_label)[0] == year


def test_year_route(spark):
    df = spark.createDataFrame([(25,), (24,), (23,), (None,)], "y int")
    got = [r[0] for r in df.select(TX.year_route(F.col("y"), 24)).collect()]
    assert got == ["skip", "process", "stop", "process"]


def test_abstract_cleanup(spark):
    rows = ["Abstract:  Some   text\nhere ", "Abstract: a\n\nb", "no label\n", "  Abstract:Abstract: x  "]
    assert _one(spark, rows, TX.abstract_cleanup) == ["Some text here", "a b", "no label", "x"]


def test_strip_label_prefix(spark):
    df = spark.createDataFrame([("  Abstract  body ", None), ("Abstract", None), ("x", " inner ")], "s string, d string")
    got = [r[0] for r in df.select(TX.strip_label_prefix("s", "d")).collect()]
    assert got == ["body", "", "inner"]


def test_conference_info_and_venue_id(spark):
    df = spark.createDataFrame([("ICLR", "24")], "c string, y string")
    vid = df.select(TX.venue_id("c", "y").alias("v")).first()["v"]
    assert vid == "ICLR.cc/2024/Conference"
    df2 = spark.createDataFrame([(vid,), ("openreview",)], "v string")
    assert [r[0] for r in df2.select(TX.conference_info("v")).collect()] == ["iclr_2024", "openreview"]


def test_prompt_snippet_fmt(spark):
    df = spark.createDataFrame([("t", "a" * 150, 0.123456)], "t string, a string, m double")
    r = df.select(TX.prompt_text("t", "a").alias("p"), TX.snippet("a").alias("s"), TX.fmt4("m").alias("f")).first()
    assert r["p"] == "Instruct: Retrive papers in similar fields to Queries.\nQueries: \nTitle: t\nAbstract: " + "a" * 150
    assert r["s"] == "a" * 100 + "..."
    assert r["f"] == "0.1235"


def test_fmt4_rounds_the_exact_binary_value(spark):
    vals = [0.55555, 2.675, 0.00005, -0.00005, 1e-20, -1e-20, 0.99995, 12345.67895, float("nan"), -0.0, 0.0]
    got = [
        r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, x double")
        .select(TX.fmt4("x"), "i").orderBy("i").collect()
    ]
    assert got == [f"{v:.4f}" for v in vals]


def test_first_line_split(spark):
    df = spark.createDataFrame([("T\nA\nB",), ("only",), ("\nx",)], "s string")
    got = [(r[0], r[1]) for r in df.select(TX.first_line("s"), TX.after_first_line("s")).collect()]
    assert got == [("T", "A\nB"), ("only", None), ("", "x")]


def test_listing_url_for_every_conference(spark):
    # the conference page URL is built the same way for every conference
    df = spark.createDataFrame([("CVPR", "24"), ("WACV", "25")], "c string, y string")
    got = [r[0] for r in df.select(TX.listing_url("c", "y", "https://host/")).collect()]
    assert got == ["https://host/CVPR2024?day=all", "https://host/WACV2025?day=all"]
