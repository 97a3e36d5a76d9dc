from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gleaner.operators import outcomes, screen
from tests import loops


def test_author_rules(spark):
    rows = [("By  JANE   ROE and X", True), ("Jane Roeson", False), (None, False),
            ("", False), ("Staff", False)]
    df = spark.createDataFrame(rows, "a string, want boolean")
    got = df.select("want", screen.author_excluded("a", ["Jane Roe"]).alias("got")).collect()
    assert all(r.want == r.got for r in got)
    d2 = spark.createDataFrame([("src10",), ("src2",)], "a string")
    got2 = [r.x for r in d2.select(screen.author_excluded("a", ["src1"]).alias("x")).collect()]
    assert got2 == [True, False]


def test_author_table_path_equals_regex(spark):
    names = ["ring", "hot gear", "Jane Roe", "src1"]
    authors = ["small ring", "hot gearbox", "hot gear", "by jane  roe", "src10", "string",
               "ring-leader", None, "", "xring"]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(authors)], "id int, a string")
    by_regex = {r.id: r.excluded for r in screen.screen_authors(df, "a", names).collect()}
    ndf = spark.createDataFrame([(n,) for n in names], "name string")
    by_join = {r.id: r.excluded for r in screen.screen_authors(df, "a", ndf).collect()}
    assert by_regex == by_join
    assert by_regex[0] and not by_regex[1] and by_regex[2] and by_regex[3]
    assert by_regex[4] and not by_regex[5] and by_regex[6] and not by_regex[9]


def test_names_match_themselves_in_every_script(spark):
    names = ["Strau\u00df", "\u0393\u03b9\u03ce\u03c1\u03b3\u03bf\u03c2", "  Jane   ROE ", "O'Neil (Jr.)", "", None]
    authors = ["STRAUSS", "strau\u00df", "\u0393\u0399\u038f\u03a1\u0393\u039f\u03a3", "\u03b3\u03b9\u03ce\u03c1\u03b3\u03bf\u03c2", "by jane roe",
               "o'neil (jr.)", "nobody", "", None]
    df = spark.createDataFrame(list(enumerate(authors)), "id int, a string")
    want = [True] * 6 + [False] * 3
    by_list = screen.screen_authors(df, "a", names).orderBy("id").collect()
    by_table = screen.screen_authors(df, "a", spark.createDataFrame([(n,) for n in names], "name string")).orderBy("id").collect()
    by_rule = df.select("id", screen.author_excluded("a", names).alias("excluded")).orderBy("id").collect()
    assert [r.excluded for r in by_list] == [r.excluded for r in by_table] == [r.excluded for r in by_rule] == want


def test_long_lists_take_the_same_path(spark):
    df = spark.createDataFrame([(1, "name 700"), (2, "xname 7")], "id int, a string")
    got = screen.screen_authors(df, "a", [f"name {i}" for i in range(1000)]).orderBy("id").collect()
    assert [r.excluded for r in got] == [True, False]


def test_only_spans_that_may_be_names_are_cut(spark):
    """A long byline yields a span for each place and length that a name's first word has."""
    authors = [" ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(600)) + " ann lee-roe, ann x",
               "o \u00e9 ann", "ann", "anna"]
    df = spark.createDataFrame([(a,) for a in authors], "_author string")
    names = spark.createDataFrame([("ann lee",), ("ann",), ("ann lee-roe",), ("\u00e9 ann",), ("zed",)], "_cand string")
    got = {(r._author[:5], r._cand) for r in screen.name_spans(df, names).collect()}
    assert got == {("waa w", "ann"), ("waa w", "ann lee"), ("waa w", "ann lee-roe"), ("o \u00e9 a", "\u00e9 ann"),
                   ("o \u00e9 a", "ann"), ("ann", "ann")}
    assert screen.name_spans(df, names).count() == 7  # of more than 180,000 spans between two boundaries


def test_ties_are_broken_by_further_order_columns(spark):
    rows = [(0, 0, "a", False), (1, 0, "a", False), (1, 0, "b", True)]
    df = spark.createDataFrame(rows, "batch int, feed_pos int, article_id string, failed boolean")
    got = outcomes.ingest_outcomes(df, order_col=["batch", "feed_pos"], excluded=None).collect()
    assert sorted((r.batch, r.article_id, r.outcome) for r in got) == [
        (0, "a", "processed"), (1, "a", "duplicate"), (1, "b", "failed")]


def test_run_without_entries_has_a_row(spark):
    none = spark.createDataFrame([], "run_id string, outcome string")
    runs = spark.createDataFrame([("r1",)], "run_id string")
    r = outcomes.run_summary(none, runs=runs).first()
    assert (r.articles_found, r.articles_failed, r.status) == (0, 0, "completed")


def test_repeat_after_success_and_failure(spark):
    rows = [(1, "a", False, False), (2, "a", False, False),
            (3, "b", False, True), (4, "b", False, False), (5, "b", False, False)]
    df = spark.createDataFrame(rows, "feed_pos long, article_id string, excluded boolean, failed boolean")
    got = [r.outcome for r in outcomes.ingest_outcomes(df).orderBy("feed_pos").collect()]
    assert got == ["processed", "duplicate", "failed", "processed", "duplicate"]


def test_cap_before_dedup(spark):
    from gleaner.operators.keys import batch_cap
    known = [f"k{i}" for i in range(10)]
    rows = [(i, k, False, False) for i, k in enumerate(known + ["new"])]
    df = spark.createDataFrame(rows, "feed_pos long, article_id string, excluded boolean, failed boolean")
    ledger = spark.createDataFrame([(k,) for k in known], "article_id string")
    capped = batch_cap(df, 10, ["feed_pos"])
    o = outcomes.ingest_outcomes(capped, ledger=ledger).withColumn("run_id", F.lit("r"))
    s = outcomes.run_summary(o).first()
    assert (s.articles_found, s.articles_processed, s.status) == (10, 0, "completed")


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abcd"), st.booleans(), st.booleans()), min_size=1, max_size=30),
       st.lists(st.sampled_from("abcd"), max_size=2))
def test_outcomes_match_loop(spark, entries, ledger):
    rows = [(i, k, ex, fa) for i, (k, ex, fa) in enumerate(entries)]
    df = spark.createDataFrame(rows, "feed_pos long, article_id string, excluded boolean, failed boolean")
    led = spark.createDataFrame([(k,) for k in ledger], "article_id string")
    got = [r.outcome for r in outcomes.ingest_outcomes(df, ledger=led).orderBy("feed_pos").collect()]
    assert got == loops.outcomes(entries, ledger)
