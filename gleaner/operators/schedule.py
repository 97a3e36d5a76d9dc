"""Publish scheduling: queue snapshots, latest queued time, slot spacing
(SRC-04 shaping, LIM-04, FLT-09, FLT-10, AGG-03, WIN-02, PRJ-13)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.functions import fixed
from gleaner.functions.timefmt import epoch_micros, iso_text, parse_iso
from gleaner.operators.common import materialize

ColumnOrName = Column | str

MICROS_PER_MINUTE = 60_000_000


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def schedule_key_regex(keys: Iterable[str] = fixed.SCHEDULE_KEYS) -> str:
    alt = "|".join(r"\Q" + k + r"\E" for k in keys)
    return r'"(?:' + alt + r')"\s*:\s*"([^"\\]*)"'


def _escaped_regex(keys: Iterable[str]) -> str:
    """Texts whose escapes may matter: a key or value under a key may be spelled with
    them, or a longer key end like one (any other string is no pair to the pattern)."""
    alt = "|".join(r"\Q" + k + r"\E" for k in keys)
    return rf'\\u00|\\"(?:{alt})"|"(?:{alt})"\s*:\s*"[^"\\]*\\'


# A JSON text as tokens: a string, with the string it is the key of, or anything between.
_JSON_STRING = r'"(?:[^"\\]|\\.)*+"'
_JSON_TOKENS = rf'(?s){_JSON_STRING}(?:\s*:\s*{_JSON_STRING})?|[^"]+|"'
_JSON_PAIR = rf'(?s)^{_JSON_STRING}\s*:\s*"'
#: Levels of nesting that a JSON text can have at all (the parser's own limit).
_JSON_LEVELS = 1000
_WALK = "struct<level:array<variant>,found:array<string>>"


def variant_strings(v: Column, keys: Iterable[str], levels: Column) -> Column:
    """String values under any of ``keys`` anywhere in a VARIANT, as an array.

    The walk goes down one level at a time, within the row: the objects and lists of a
    level are opened together, matching entries are noted, and everything in them is
    the next level.  ``levels`` bounds its depth; levels below the last are empty."""
    wanted = [F.lit(k) for k in keys]

    def down(state: Column, _: Column) -> Column:
        opened = F.transform(state["level"], lambda x: F.struct(
            F.try_variant_get(x, "$", "map<string,variant>").alias("fields"),
            F.try_variant_get(x, "$", "array<variant>").alias("items")))
        fields = F.filter(F.transform(opened, lambda o: o["fields"]), lambda m: m.isNotNull())
        items = F.filter(F.transform(opened, lambda o: o["items"]), lambda a: a.isNotNull())
        named = F.flatten(F.transform(fields, lambda m: F.filter(F.map_entries(m), lambda e: (
            e["key"].isin(*wanted) & (F.schema_of_variant(e["value"]) == "STRING")))))
        found = F.transform(named, lambda e: F.try_variant_get(e["value"], "$", "string"))
        return F.struct(F.concat(F.flatten(F.transform(fields, lambda m: F.map_values(m))), F.flatten(items)).alias("level"),
                        F.concat(state["found"], found).alias("found")).cast(_WALK)

    start = F.struct(F.array(v).alias("level"), F.array().cast("array<string>").alias("found")).cast(_WALK)
    return F.aggregate(F.sequence(F.lit(1), levels), start, down, lambda state: state["found"])


def _pair_strings(body: Column, keys: Iterable[str]) -> Column:
    """The same from the text's tokens, for JSON that VARIANT does not take (a key that
    stands twice in one object, a text beyond its size): every value counts."""
    pairs = F.filter(F.regexp_extract_all(body, F.lit(_JSON_TOKENS), 0), lambda t: t.rlike(_JSON_PAIR))
    entries = F.flatten(F.transform(pairs, lambda t: F.map_entries(
        F.from_json(F.concat(F.lit("{"), t, F.lit("}")), "map<string,string>"))))
    return F.transform(F.filter(entries, lambda e: e["key"].isin(*[F.lit(k) for k in keys])), lambda e: e["value"])


def schedule_values(body: ColumnOrName, keys: Iterable[str] = fixed.SCHEDULE_KEYS) -> Column:
    """FLT-10: string values stored under any schedule key, at any depth of the JSON
    text, as the JSON parser reads them (escapes in keys and values included).

    Where no escape can matter a pattern finds the pairs; any other text is parsed to a
    VARIANT and walked."""
    body, keys = _col(body), list(keys)
    brackets = F.length(body) - F.length(F.translate(body, "{[", ""))
    # The VARIANT is bound once, as a one-element array.
    walked = F.element_at(F.transform(F.array(F.try_parse_json(body)), lambda v: F.when(
        v.isNotNull(), variant_strings(v, keys, F.least(F.greatest(brackets, F.lit(1)), F.lit(_JSON_LEVELS))))), 1)
    plain = F.regexp_extract_all(body, F.lit(schedule_key_regex(keys)), 1)
    valid = F.get_json_object(body, "$").isNotNull()
    as_is = ~body.contains("\\") | ~body.rlike(_escaped_regex(keys))
    return F.when(as_is, plain).otherwise(
        F.coalesce(walked, F.when(valid, _pair_strings(body, keys)), F.array().cast("array<string>")))


def latest_queued(queue: DataFrame, now: ColumnOrName, group_cols: Sequence[str] = (),
                  body: str = "body", page: str | None = "page",
                  max_pages: int | None = None,
                  keys: Iterable[str] = fixed.SCHEDULE_KEYS,
                  out: str = "latest") -> DataFrame:
    """AGG-03 (+ LIM-04, FLT-09): the latest queued publish time at or after
    ``now`` per group (null when there is none).

    Values are pulled from the raw JSON text row-locally, exploded, parsed
    (text without an offset is UTC; unparseable text is ignored) and
    reduced with a partial ``max``; ``max_pages`` skips pages from that number on."""
    q = queue
    if page is not None and max_pages is not None:
        q = q.where(F.col(page) < max_pages)
    vals = q.select(*group_cols, F.explode_outer(schedule_values(body, keys)).alias("_v"))
    ts = parse_iso(F.col("_v"))
    keep = F.when(ts >= _col(now).cast("timestamp"), ts)
    if group_cols:
        return vals.groupBy(*group_cols).agg(F.max(keep).alias(out))
    return vals.agg(F.max(keep).alias(out))


def publish_slots(df: DataFrame, time_col: str, key_col: str,
                  channel_cols: Sequence[str] = (),
                  spacing_minutes: int = fixed.PUBLISH_SPACING_MINUTES,
                  latest: ColumnOrName | None = None,
                  fixed_at: ColumnOrName | None = None,
                  out: str = "slot", block_rows: int = 500_000,
                  order_cols: Sequence[str] = ()) -> DataFrame:
    """WIN-02: give every row a publish slot; ``key_col`` is unique (one null key may be among them).

    Loop semantics, per channel in (time, ``order_cols``, key) order, with ``t`` the row's
    arrival time: ``slot = max(t, previous slot + spacing)``; the first slot
    is also at least ``latest + spacing`` when the channel's queue already
    holds a later post.  Closed form, with ``i`` the row's index and ``d``
    the spacing:  ``slot_i = i*d + max(latest + d, max_{j<=i}(t_j - j*d))``.

    The running max is a prefix scan, computed in parallel so that a channel
    holding a large share of all rows is never sorted in one task:

    1. a sampled range partitioning of (channel, time, order, key) cuts the rows into
       similarly sized contiguous blocks, whatever the skew, bursts and ties;
       only these columns are shuffled, and written once with their block
       (so that a recomputation cannot renumber it);
    2. a window inside a block gives the local index and running max, a partial
       aggregate each block's row count and max;
    3. a window over the block table (one row per channel and block) gives the
       rows before a block and the max carried in;
    4. rows join their block's carry; other columns are joined back at the end.

    ``fixed_at`` gives every row that same slot (a configured time)."""
    if fixed_at is not None:
        return df.withColumn(out, _col(fixed_at).cast("timestamp"))
    d = int(spacing_minutes) * MICROS_PER_MINUTE
    names = [f"_c{i}" for i in range(len(channel_cols))]
    order = ["_t", *[f"_o{i}" for i in range(len(order_cols))], "_k"]
    thin = df.select(*[F.col(c).alias(n) for c, n in zip(channel_cols, names)],
                     *[F.col(c).alias(n) for c, n in zip(order_cols, order[1:-1])],
                     F.col(key_col).alias("_k"), epoch_micros(time_col).alias("_t"))
    n_blocks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // block_rows))
    thin = materialize(thin.repartitionByRange(n_blocks, *names, *order)
                           .withColumn("_b", F.spark_partition_id().cast("bigint")), "slot_blocks")
    wb = Window.partitionBy(*names, "_b").orderBy(*order)
    rows = (thin.withColumn("_j", (F.row_number().over(wb) - 1).cast("bigint"))
                .withColumn("_v", F.col("_t") - F.col("_j") * F.lit(d))
                .withColumn("_lmax", F.max("_v").over(
                    wb.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    blocks = rows.groupBy(*names, "_b").agg(F.count(F.lit(1)).alias("_n"), F.max("_v").alias("_bmax"))
    wc = Window.partitionBy(*names).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_off", F.coalesce(F.sum("_n").over(wc), F.lit(0)).cast("bigint"))
    blocks = (blocks.withColumn("_vo", F.col("_bmax") - F.col("_off") * F.lit(d))
                    .withColumn("_carry", F.max("_vo").over(wc))
                    .select(*[F.col(n).alias(f"_x{n}") for n in names], F.col("_b").alias("_xb"), "_off", "_carry"))
    same = F.col("_b") == F.col("_xb")
    for n in names:
        same = same & F.col(n).eqNullSafe(F.col(f"_x{n}"))
    prefix = F.greatest(F.col("_carry"), F.col("_lmax") - F.col("_off") * F.lit(d))
    if latest is not None:
        prefix = F.greatest(prefix, epoch_micros(_col(latest)) + F.lit(d))
    slot = F.timestamp_micros((F.col("_off") + F.col("_j")) * F.lit(d) + prefix)
    slots = rows.join(blocks, same).select(F.col("_k"), slot.alias("_slot"))
    return df.join(slots, F.col(key_col).eqNullSafe(F.col("_k"))).withColumn(out, F.col("_slot")).drop("_k", "_slot")


def slot_text(c: ColumnOrName) -> Column:
    """PRJ-13: slot as ISO text with ``Z``."""
    return iso_text(c, "Z")
