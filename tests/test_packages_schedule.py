import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gleaner.functions import fixed
from gleaner.operators import outbox, packages, schedule
from gleaner.sources.tables import parse_responses
from tests import loops


def _err(spark, mode, single, thread, allow=True):
    df = spark.createDataFrame([(mode, single, thread)], "m string, s string, t array<string>")
    return packages.validate_packages(df, "m", "s", "t", allow_thread=allow).first().error


def test_validation_rules(spark):
    assert _err(spark, "single", "a" * 280, []) is None
    assert _err(spark, "single", "a" * 281, []) == fixed.ERR_SINGLE_TOO_LONG.format(max=280)
    assert _err(spark, " SINGLE ", "", []) == fixed.ERR_SINGLE_MISSING
    assert _err(spark, "single", "x", ["y"]) == fixed.ERR_SINGLE_HAS_THREAD
    assert _err(spark, "thread", "", ["a", "b"]) == fixed.ERR_THREAD_SIZE
    assert _err(spark, "thread", "", ["a", "b", "c"]) is None
    assert _err(spark, "thread", "", ["a", "b", "c", "d"]) == fixed.ERR_THREAD_SIZE
    assert _err(spark, "thread", "", ["a", " ", "b", "c"]) is None
    assert _err(spark, "thread", "x", ["a", "b", "c"]) == fixed.ERR_THREAD_HAS_SINGLE
    assert _err(spark, "thread", "", ["a", "b" * 281, "c"]) == "thread tweet 2 exceeds 280 characters"
    assert _err(spark, "thread", "", ["a", "b", "c"], allow=False) == fixed.ERR_THREAD_DISABLED
    assert _err(spark, "both", "", []) == fixed.ERR_BAD_MODE


ITEM = st.sampled_from(["", " ", "ok", "x" * 5, "y" * 9])


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["single", "thread", "Thread", "bad"]),
                          st.sampled_from(["", "s", "z" * 9]),
                          st.lists(ITEM, max_size=5)), min_size=1, max_size=6))
def test_long_form_equals_array_form(spark, pkgs):
    rows = [(i, m, s, t) for i, (m, s, t) in enumerate(pkgs)]
    arr = spark.createDataFrame(rows, "k int, delivery_mode string, single_tweet string, thread array<string>")
    a = {r.k: r.error for r in packages.validate_packages(arr, max_chars=6).collect()}
    items = spark.createDataFrame([(i, j, x) for i, (_, _, t) in enumerate(pkgs) for j, x in enumerate(t)],
                                  "k int, pos int, text string")
    lf = packages.validate_long(arr.drop("thread"), items, "k", "pos", "text", max_chars=6)
    b = {r.k: r.error for r in lf.collect()}
    assert a == b


def test_promo(spark):
    df = spark.createDataFrame([("Previews are up", None), ("already", ["fine"]), ("x", ["Check  out"])],
                               "s string, t array<string>")
    got = [r.p for r in df.select(packages.promo_flag("s", "t").alias("p")).collect()]
    assert got == [True, False, False]


def test_parse_responses(spark):
    rows = [('{"delivery_mode":" Single ","single_tweet":" hi ","thread":[" a ",""," "]}',),
            ("not json",), ('{"delivery_mode":"thread","thread":"abc"}',), ('{"thread":null}',)]
    df = parse_responses(spark.createDataFrame(rows, "response string"))
    r = df.collect()
    assert (r[0].delivery_mode, r[0].single_tweet, list(r[0].thread), r[0].parse_error) == ("single", "hi", ["a"], None)
    assert r[1].parse_error is not None
    assert r[2].parse_error == "thread is not a list"
    assert (list(r[3].thread), r[3].parse_error) == ([], None)


def test_queue_keys_and_latest(spark):
    bodies = [(0, '{"a":[{"meta":{"scheduledAt":"2027-01-05T10:00:00+02:00"}}]}'),
              (0, '{"note":"\\"publish_at\\": \\"2099-01-01\\"","publish_at":"2026-01-01T00:00:00Z"}'),
              (1, '{"x":{"scheduled_date":5,"scheduleDate":"garbage"}}'),
              (12, '{"publishAt":"2030-01-01T00:00:00"}')]
    q = spark.createDataFrame(bodies, "page int, body string")
    out = schedule.latest_queued(q, F.lit("2026-06-01 00:00:00").cast("timestamp"), max_pages=10)
    assert out.first().latest == dt.datetime(2027, 1, 5, 8, 0)


def test_slot_after_queue_and_stale(spark):
    df = spark.createDataFrame([(1, dt.datetime(2026, 1, 1, 10, 0)), (2, dt.datetime(2026, 1, 1, 10, 0))],
                               "k int, t timestamp")
    s = schedule.publish_slots(df, "t", "k", latest=F.lit(dt.datetime(2026, 1, 1, 10, 10)))
    assert [r.slot for r in s.orderBy("k").collect()] == [dt.datetime(2026, 1, 1, 10, 40),
                                                         dt.datetime(2026, 1, 1, 11, 10)]
    s2 = schedule.publish_slots(df.limit(1), "t", "k")
    assert s2.first().slot == dt.datetime(2026, 1, 1, 10, 0)
    txt = df.select(schedule.slot_text(F.lit(dt.datetime(2026, 1, 1, 10, 0, 0, 5))).alias("x")).first().x
    assert txt == "2026-01-01T10:00:00.000005Z"


def test_slots_for_one_arrival_time(spark):
    base = dt.datetime(2026, 1, 1, 9, 0)
    df = spark.createDataFrame([(k, base) for k in range(0, 50, 3)], "k int, t timestamp")
    got = [r.slot for r in schedule.publish_slots(df, "t", "k", (), 30)
           .orderBy("k").collect()]
    assert got == [base + dt.timedelta(minutes=30 * i) for i in range(len(got))]


def test_slots_range_blocks_match_loop(spark):
    import random
    rnd = random.Random(5)
    base = dt.datetime(2026, 1, 1)
    rows = [(i, 0 if i % 3 else rnd.randrange(1, 4), base + dt.timedelta(minutes=rnd.choice([0, 0, 5, 90])))
            for i in range(400)]  # bursts: many rows share one arrival time
    df = spark.createDataFrame(rows, "k int, ch int, t timestamp")
    got = {r.k: r.slot for r in schedule.publish_slots(df, "t", "k", ["ch"], 30, block_rows=60).collect()}
    for ch in {c for _, c, _ in rows}:
        mine = sorted((t, k) for k, c, t in rows if c == ch)
        want = loops.slots([int((t - base).total_seconds() // 60) for t, _ in mine], 30)
        assert [got[k] for _, k in mine] == [base + dt.timedelta(minutes=w) for w in want]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 600)), min_size=1, max_size=40),
       st.sampled_from([3, 100000]), st.one_of(st.none(), st.integers(0, 300)))
def test_slots_match_loop(spark, arrivals, block, latest):
    base = dt.datetime(2026, 1, 1)
    rows = [(i, ch, base + dt.timedelta(minutes=m)) for i, (ch, m) in enumerate(arrivals)]
    df = spark.createDataFrame(rows, "k int, ch int, t timestamp")
    lat = F.lit(base + dt.timedelta(minutes=latest)) if latest is not None else None
    got = {r.k: r.slot for r in schedule.publish_slots(df, "t", "k", ["ch"], 30, latest=lat,
                                                       block_rows=block).collect()}
    for ch in {c for _, c, _ in rows}:
        mine = sorted((t, k) for k, c, t in rows if c == ch)
        mins = [int((t - base).total_seconds() // 60) for t, _ in mine]
        want = loops.slots(mins, 30, latest)
        for (t, k), w in zip(mine, want):
            assert got[k] == base + dt.timedelta(minutes=w)


def test_outbox_payload_and_remote_id(spark):
    import json
    df = spark.createDataFrame([("thread", "", ["a", "b", "c"], "https://x/1 ")],
                               "m string, s string, t array<string>, url string")
    r = df.select(outbox.read_more("url").alias("reply"), "m", "s", "t").select(
        outbox.outbox_payload(outbox.post_list("m", "s", "t", "reply"), F.lit("publish_now")).alias("p"),
        outbox.draft_payload("m", "s", "t", F.lit(None).cast("string")).alias("d")).first()
    p = json.loads(r.p)
    assert [x["text"] for x in p["platforms"]["x"]["posts"]] == ["a", "b", "c", "Read more: https://x/1"]
    assert p["publish_at"] == "now"
    assert json.loads(r.d) == {"thread": ["a", "b", "c"], "reply": None}
    ids = spark.createDataFrame([('{"id": 7}',), ('{"id": "", "draft": {"id": "d9"}}',), ("{}",)], "b string")
    assert [x.r for x in ids.select(outbox.remote_id("b").alias("r")).collect()] == ["7", "d9", ""]


def test_parse_response_item_types(spark):
    rows = [('{"delivery_mode": "thread", "thread": ["a", null, 5, "  "], "single_tweet": null}',)]
    r = parse_responses(spark.createDataFrame(rows, "response string")).first()
    assert (r.delivery_mode, r.single_tweet, list(r.thread), r.parse_error) == ("thread", "", ["a", "5"], None)


def _walk(obj, keys):
    """The values a walk over the parsed document meets."""
    if isinstance(obj, dict):
        for k, v in obj.items():
            if k in keys and isinstance(v, str):
                yield v
            yield from _walk(v, keys)
    elif isinstance(obj, list):
        for v in obj:
            yield from _walk(v, keys)


def test_schedule_values_equal_a_walk_over_the_parsed_json(spark):
    """Random documents with every way of writing a string, and texts VARIANT does not take."""
    import json
    import random

    from gleaner.functions import fixed

    rnd = random.Random(8)
    names = [*fixed.SCHEDULE_KEYS, "x", 'a"publish_at', "publish_at\\", "note"]
    words = ["2030-01-01T00:00:00+00:00", '"publish_at":"no"', "a\\", "é/\t", "", '","publish_at":"']

    def text(s):
        return '"' + "".join(
            f"\\u{ord(c):04x}" if rnd.random() < 0.1 else json.dumps(c)[1:-1] if c in '"\\\t' or rnd.random() < 0.5 else c
            for c in s) + '"'

    def doc(depth):
        kind = rnd.random()
        if depth == 0 or kind < 0.3:
            return rnd.choice([text(rnd.choice(words)), text(rnd.choice(words)), "null", "1.5", "true"])
        gap = rnd.choice(["", " ", "\n "])
        if kind < 0.55:
            return "[" + f",{gap}".join(doc(depth - 1) for _ in range(rnd.randint(0, 3))) + "]"
        inner = rnd.sample(names, rnd.randint(0, 4))
        return "{" + ",".join(f"{gap}{text(k)}{gap}:{gap}{doc(depth - 1)}" for k in inner) + "}"

    bodies = ["{" + f'"d":{doc(rnd.randint(0, 6))}' + "}" for _ in range(1200)]
    deep = '{"b":[' * 300 + '{"publish_at":"\\u0041"}' + "]}" * 300
    bodies += [deep, "{}", "[]", '{"publish_at":"a\\u0062"}']
    rows = spark.createDataFrame(list(enumerate(bodies)), "i int, body string")
    got = {r.i: sorted(r.v) for r in rows.select("i", schedule.schedule_values("body").alias("v")).collect()}
    for i, body in enumerate(bodies):
        assert got[i] == sorted(_walk(json.loads(body), set(fixed.SCHEDULE_KEYS))), body
    odd = spark.createDataFrame([(None,), ("no json \\u0041",), ('{"publish_at":"\\u0061","publish_at":"b"}',)], "body string")
    assert [r.v for r in odd.select(schedule.schedule_values("body").alias("v")).collect()] == [[], [], ["a", "b"]]
