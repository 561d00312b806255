from pyspark.sql import functions as F

from papertriage.operators import listing as LS
from papertriage.sources.pages import RULES, extract_fields, extract_page


def test_take_while_fixture_example(spark):
    # (page, pos, year), target 24 keeps (1,2) (2,1) (2,3)
    rows = [(1, 1, 25), (1, 2, None), (2, 1, 24), (2, 2, 25), (2, 3, 24), (3, 1, 24), (3, 2, 23)]
    df = spark.createDataFrame([("v", p, q, y) for p, q, y in rows], "venue string, page_no int, pos int, year int")
    from papertriage.functions.text import year_route

    routed = df.withColumn("route", year_route(F.col("year"), 24))
    got = sorted((r["page_no"], r["pos"]) for r in LS.take_while(routed, 24, ["venue"]).collect())
    assert got == [(1, 2), (2, 1), (2, 3)]


def test_take_while_no_target_keeps_all_pages(spark):
    rows = [(1, 1, 26), (2, 1, None), (3, 1, 25)]
    df = spark.createDataFrame([("v", p, q, y) for p, q, y in rows], "venue string, page_no int, pos int, year int")
    from papertriage.functions.text import year_route

    routed = df.withColumn("route", year_route(F.col("year"), 24))
    assert [(r["page_no"], r["pos"]) for r in LS.take_while(routed, 24, ["venue"]).collect()] == [(2, 1)]


def test_technical_tracks_filter(spark):
    df = spark.createDataFrame(
        [("AAAI-24 Technical Tracks 1", "u"), ("Technical Tracks", None), ("Student Abstracts", "u")],
        "track_title string, track_url string",
    )
    assert LS.technical_tracks(df).count() == 1


def test_link_dict_last_href_first_position(spark):
    html = '<nav><a href="/a">A</a><a href="/b">B</a><a href="/c">A</a></nav>'
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    got = sorted((r["link_text"], r["href"], r["pos"]) for r in LS.link_dict(LS.page_links(df)).collect())
    assert got == [("A", "/c", 1), ("B", "/b", 2)]
    in_row = sorted((r["link_text"], r["href"], r["pos"]) for r in LS.page_link_dict(df).collect())
    assert in_row == got
    assert {k: v for k, v in {"A": "/a", "B": "/b", "A": "/c"}.items()} == {"A": "/c", "B": "/b"}  # noqa: F601


def test_detail_join_rejects(spark):
    listing = spark.createDataFrame([(1, "u1"), (2, "u2")], "pos int, url string")
    pages = spark.createDataFrame([("u1", "<h1>x</h1>")], "url string, html string")
    matched, rejects = LS.detail_join(listing, pages)
    assert [r["pos"] for r in matched.collect()] == [1]
    assert [(r["pos"], r["reason"]) for r in rejects.collect()] == [(2, "page not stored")]


def test_extract_layouts(spark):
    def extract(html, layout):
        df = spark.createDataFrame([(html,)], "h string").select(extract_fields("h", layout).alias("f")).select("f.*")
        return df.first().asDict(recursive=True)

    aaai = (
        '<h1 class="page_title"> A &amp; B </h1><section class="item abstract">'
        "<h2 class=label>Abstract</h2> The  text </section>"
    )
    r = extract(aaai, "aaai")
    assert r["title"] == "A & B" and r["abstract"] == "The  text"
    r = extract('<section class="item abstract">Abstract<div> inner </div></section>', "aaai")
    assert r["abstract"] == "inner"
    cvf = '<div id="papertitle">T</div><div id="abstract"> abs </div><dl><dt><a href="/p1">P1</a></dt></dl>'
    r = extract(cvf, "cvf")
    assert (r["title"], r["abstract"], r["links"]) == ("T", "abs", [{"pos": 1, "text": "P1", "href": "/p1"}])
    r = extract('<p>x</p><a rel="next" href="/n">next</a>', "generic")
    assert r["next_url"] == "/n" and r["title"] is None
    r = extract('<a class="next" href="/p2">Next</a>', "aaai")
    assert r["next_url"] == "/p2"
    listing = (
        '<ul class="cmp_article_list articles"><li><div class="obj_article_summary">'
        '<h3 class="title"><a href="/v/1">Paper one</a></h3><a href="/pdf/1">PDF</a></div></li></ul>'
    )
    assert extract(listing, "aaai")["links"] == [{"pos": 1, "text": "Paper one", "href": "/v/1"}]
    broken = '<div id="papertitle">On<br>time</div><div id="abstract">one.<br>Two<p>three</p>four <b>fi</b>ve</div>'
    r = extract(broken, "cvf")
    assert r["title"].split("\n") == ["On", "time"] and r["abstract"].split() == ["one.", "Two", "three", "four", "five"]
    assert extract(None, "cvf")["abstract"] is None


def test_next_page_fast_path(spark):
    from papertriage.sources.pages import next_page_url

    df = spark.createDataFrame([('<a class="next" href="/p2">n</a>',), ('<a rel="next" href="/p3">n</a>',), ("<p>",)], "h string")
    assert [r[0] for r in df.select(next_page_url("h")).collect()] == ["/p2", "/p3", None]


def test_extract_udf_matches_python(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")

    got = {r["page_id"]: r["f"]["title"] for r in pages.select("page_id", extract_fields("html").alias("f")).collect()}
    exp = {r["page_id"]: (extract_page(r["html"], RULES["generic"])["title"] or "").strip() or None for r in pages.collect()}
    assert got == exp


def test_take_while_target_after_stop(spark):
    from papertriage.functions.text import year_route

    rows = [(1, 1, 25), (1, 2, 23), (2, 1, 24), (1, 3, None)]
    df = spark.createDataFrame([("v", p, q, y) for p, q, y in rows], "venue string, page_no int, pos int, year int")
    routed = df.withColumn("route", year_route(F.col("year"), 24))
    assert LS.take_while(routed, 24, ["venue"]).count() == 0
