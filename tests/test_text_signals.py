import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gleaner.functions import signals as S
from gleaner.functions import text as T
from tests import loops


def one_col(spark, values, name="t"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def test_stat_patterns_hand_rows(spark):
    rows = {
        "55.5% of games": False,
        "55.5%x": True,
        "in 2024 the": True,
        "12345": False,
        "pick'em PK": True,
        "pkg": False,
        "10-2": True,
        "Under45": True,
        "OVER 45.55": True,
        "overtime": False,
        "é100": False,
    }
    df = one_col(spark, list(rows)).select("t", S.is_stat(F.col("t")).alias("hit"))
    got = {r.t: r.hit for r in df.collect()}
    assert got == rows


def test_angle_substrings(spark):
    rows = {"stats": True, "knowledge": True, "marketing": True, "plain words": False}
    df = one_col(spark, list(rows)).select("t", S.is_angle(F.col("t")).alias("hit"))
    assert {r.t: r.hit for r in df.collect()} == rows


def test_clean_drops_disclaimer_and_short(spark):
    text = "  Keep me  \n\nODDS ARE SUBJECT TO CHANGE.\nx\n　second line "
    df = one_col(spark, [text]).select(T.clean_text(F.col("t")).alias("c"))
    assert df.first().c == "Keep me\nsecond line"


def test_cap_overshoot_and_stop(spark):
    stats20 = "\n".join(f"line {i}-{i}" for i in range(20))
    stop = "\n".join([f"team {i}-{i}" for i in range(12)] + ["plain text here", "late 3-4"])
    df = one_col(spark, [stats20, stop]).select(
        F.size(S.key_points(T.clean_lines(F.col("t")), cap=12)).alias("n"))
    assert [r.n for r in df.collect()] == [20, 12]


def test_strict_cap(spark):
    stats20 = "\n".join(f"line {i}-{i}" for i in range(20))
    df = one_col(spark, [stats20]).select(
        F.size(S.key_points(T.clean_lines(F.col("t")), cap=12, strict_cap=True)).alias("n"))
    assert df.first().n == 12


LINE = st.sampled_from([
    "Record 10-2 ATS", "plain words only", "the market moved", "55.5%x", "x", "",
    "   ", "Over 45.5 total", "Gambling problem? call", "just text", "edge case",
    " spaced ", "trend up", "2024 season", "pk", "nothing",
])


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(LINE, max_size=25), min_size=1, max_size=6), st.integers(0, 6))
def test_key_points_match_loop(spark, docs, cap):
    texts = ["\n".join(d) for d in docs]
    df = one_col(spark, texts).select(
        "t", S.key_points(T.clean_lines(F.col("t")), cap=cap).alias("p"))
    got = {r.t: list(r.p) for r in df.collect()}
    for t in texts:
        assert got[t] == loops.capped_points(loops.clean_lines(t), cap), t


CHARS = st.sampled_from(list("ab 1-\n\r\t\x0b\x0c\x1c\x1d\x1e\x1f\x85  　 ") + ["x"])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(CHARS, max_size=30), min_size=1, max_size=8))
def test_clean_lines_match_python_strip_and_splitlines(spark, texts):
    df = one_col(spark, texts).select("t", T.clean_lines(F.col("t"), markup=False).alias("l"))
    for r in df.collect():
        assert list(r.l) == loops.clean_lines(r.t), repr(r.t)


def test_markup_text_and_entities(spark):
    html = "<p>A &amp;lt; B</p><!-- c --><script>var t='</p>';</script><b>Bold<p>next &copy; x"
    df = one_col(spark, [html]).select(T.clean_text(F.col("t")).alias("c"))
    assert df.first().c == "A &lt; B\nBold\nnext © x"


def test_page_boilerplate(spark):
    from gleaner.operators.article import page_bodies
    html = ("<html><head><title>T</title><style>p{}</style></head><body><nav>menu</nav>"
            "<div class=\"ad big\">buy</div><header>h</header><article><h1>Head</h1>"
            "<p>Body text</p></article><footer>f</footer></body></html>")
    no_article = "<html><body><div class='menu'>m</div><p>Only</p><aside>a</aside></body></html>"
    df = spark.createDataFrame([(1, html), (2, no_article)], "id int, html string")
    got = {r.id: (r.article_text, r.page_text) for r in page_bodies(df).collect()}
    assert got[1] == ("Head\nBody text", "T\nHead\nBody text")
    assert got[2] == (None, "Only")


def test_body_ladder_edges(spark):
    from gleaner.operators.article import body_ladder
    feed = spark.createDataFrame(
        [("u1", "a" * 500), ("u2", "<b>" + "a" * 501 + "</b>"), ("u3", ""), ("u4", "short")],
        "url string, feed_content string")
    pages = spark.createDataFrame(
        [("u1", "<article>Art one</article>"), ("u3", "<p>Whole page</p>")],
        "url string, html string")
    got = {r.url: (r.body_source, r.body) for r in body_ladder(feed, pages).collect()}
    assert got["u1"] == ("article", "Art one")
    assert got["u2"][0] == "feed"
    assert got["u3"] == ("page", "Whole page")
    assert got["u4"] == ("missing", None)


def test_sha_key_fallback(spark):
    from gleaner.operators.keys import article_key
    df = spark.createDataFrame([(None, "", "L")], "id string, guid string, link string")
    got = df.select(article_key("id", "guid", "link").alias("k")).first().k
    assert got == hashlib.sha256(b"L").hexdigest()


def test_numeric_character_references(spark):
    text = "a &#8217; b &#x1F600; c &amp;#38; &#65 &#55296; &#0; &lt;x"
    df = one_col(spark, [text]).select(T.decode_entities(F.col("t")).alias("d"))
    assert df.first().d == "a ’ b \U0001F600 c &#38; &#65 &#55296; &#0; <x"


def test_named_references_decode_once(spark):
    text = "caf&eacute; &amp;lt;b&amp;gt; &copy; &middot; &notanentity; & alone &apos;q&apos;"
    df = one_col(spark, [text]).select(T.decode_entities(F.col("t")).alias("d"))
    assert df.first().d == "café &lt;b&gt; © · &notanentity; & alone 'q'"


def test_comparison_signs_are_not_tags(spark):
    df = one_col(spark, ["<p>if x < 5 and y > 3</p>"]).select(T.clean_text(F.col("t")).alias("c"))
    assert df.first().c == "if x < 5 and y > 3"


def test_quoted_angle_bracket_in_attribute(spark):
    df = one_col(spark, ['<a title="x>y" href=\'q>r\'>Link</a> tail']).select(T.clean_text(F.col("t")).alias("c"))
    assert df.first().c == "Link\ntail"


def test_class_attribute_forms(spark):
    from gleaner.operators.article import page_bodies
    html = ("<body><div class=ad>a1</div><div data-class=\"ad\">keep1</div>"
            "<div id=x class=\"big ad\">a2</div><span class='menu'>m</span>"
            "<p class=adverts>keep2</p><img class=ad/><p>keep3</p></body>")
    df = spark.createDataFrame([(1, html)], "id int, html string")
    assert page_bodies(df).first().page_text == "keep1\nkeep2\nkeep3"


def test_null_and_empty_text(spark):
    df = spark.createDataFrame([(None,), ("",), ("   ",)], "t string")
    rows = df.select(T.clean_text(F.col("t")).alias("c"),
                     F.size(S.key_points(T.clean_lines(F.col("t")))).alias("n")).collect()
    assert [(r.c, r.n) for r in rows] == [("", 0), ("", 0), ("", 0)]
