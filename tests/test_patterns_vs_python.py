"""Java-side patterns against Python's ``re`` on random strings drawn from an
alphabet that stresses word boundaries, digits, case and whitespace."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gleaner.functions import fixed
from gleaner.functions import signals as S
from gleaner.operators import packages, screen

ALPHA = list("0123456789-+.%pPkKoOuUvVeErRnNdD aé ßçİ\t_,") + ["Over", "UNDER", "pk", "PK", "5.5%", "12-3"]
TEXT = st.lists(st.sampled_from(ALPHA), max_size=14).map("".join)


def py_stat(s: str) -> dict:
    out = {}
    for name, p in fixed.STAT_PATTERNS.items():
        flags = re.IGNORECASE if fixed.STAT_IGNORECASE[name] else 0
        out[name] = re.search(p, s, flags) is not None
    return out


@settings(max_examples=40, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=25))
def test_stat_patterns_match_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    cols = [c.alias(n) for n, c in S.stat_flags(F.col("t")).items()]
    for r in df.select("t", S.is_stat(F.col("t")).alias("any"), *cols).collect():
        want = py_stat(r.t)
        got = {n: r[n] for n in fixed.STAT_PATTERNS}
        assert got == want, r.t
        assert r["any"] == any(want.values()), r.t


NAME_ALPHA = list("abcxyz  1-.é") + ["bill", "adee", "src1", "Src10", "BILL"]
NAME = st.lists(st.sampled_from(NAME_ALPHA), min_size=1, max_size=8).map("".join)


def _outside_az(text, i):
    """True when position i is off the text or holds a character outside a-z."""
    return i < 0 or i >= len(text) or not ("a" <= text[i] <= "z")


def py_excluded(author, names):
    """Brute force: every occurrence of every name, neighbours checked."""
    if not author:
        return False
    a = " ".join(author.split()).casefold()
    for name in names:
        n = " ".join((name or "").split()).casefold()
        if not n:
            continue
        start = a.find(n)
        while start != -1:
            if _outside_az(a, start - 1) and _outside_az(a, start + len(n)):
                return True
            start = a.find(n, start + 1)
    return False


@settings(max_examples=40, deadline=None)
@given(st.lists(NAME, min_size=1, max_size=20), st.lists(NAME, min_size=1, max_size=3))
def test_author_rule_matches_python(spark, authors, names):
    df = spark.createDataFrame([(i, a) for i, a in enumerate(authors)], "i int, a string")
    got = {r.i: r.x for r in df.select("i", screen.author_excluded("a", names).alias("x")).collect()}
    table = spark.createDataFrame([(n,) for n in names], "name string")
    got_t = {r.i: r.excluded for r in screen.screen_authors(df, "a", table).collect()}
    for i, a in enumerate(authors):
        assert got[i] == py_excluded(a, names), (a, names)
        assert got_t[i] == got[i], (a, names)


PROMO_ALPHA = list("abc .,!é") + ["read", "Read", "previews", "preview", "check out", "already", "é", "_"]
PROMO = st.lists(st.sampled_from(PROMO_ALPHA), max_size=10).map("".join)


@settings(max_examples=40, deadline=None)
@given(st.lists(PROMO, min_size=1, max_size=20))
def test_promo_matches_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", packages.promo_flag("t").alias("p")).collect():
        want = any(re.search(p, r.t.lower()) for p in fixed.PROMO_PATTERNS)
        assert r.p == want, r.t
