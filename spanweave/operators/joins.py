"""Joins beyond plain equality: as-of, interval overlap, alternative keys, prioritised candidates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanweave.operators.windows import keep_first

#: Right spans of a key that one task joins without slices of time.
SLICED_ROWS = 1000


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_ts: str,
    right_ts: str,
    direction: str = "forward",
    allow_exact: bool = True,
    tie: Sequence[str] = (),
    slice_by: Column | None = None,
) -> DataFrame:
    """Every left row with the nearest right row of its key at or after (backward: before) its time; unmatched rows get nulls.

    Both sides are read once, in one running window over their union, so cost is linear in a key's rows. Of right rows at
    the same time the first by ``tie`` is taken. Null keys or times match nothing. Right columns whose names the left side has are left out.
    ``slice_by``, an expression over a column ``_ts`` that never decreases as time grows (a date, say), cuts keys that hold
    very many rows into slices of time: each is ordered apart, and rows without a match in their slice take the nearest one
    of the following slices.
    """
    forward = direction == "forward"
    extra = [c for c in right.columns if c not in left.columns]
    rows = left.select(F.struct(*left.columns).alias("_left"), *by, F.col(left_ts).alias("_ts"), F.lit(1).alias("_side"), F.lit(None).cast(right.select(F.struct(*right.columns).alias("s")).schema["s"].dataType).alias("_right"))
    usable = right.where(F.col(right_ts).isNotNull())
    for c in by:
        usable = usable.where(F.col(c).isNotNull())
    pool = usable.select(F.lit(None).cast(rows.schema["_left"].dataType).alias("_left"), *by, F.col(right_ts).alias("_ts"), F.lit(0).alias("_side"), F.struct(*right.columns).alias("_right"))
    union = rows.unionByName(pool)
    keys = list(by)
    if slice_by is not None:
        union = union.withColumn("_slice", slice_by)
        keys.append("_slice")
    time = F.col("_ts").desc_nulls_last() if forward else F.col("_ts").asc_nulls_first()
    # the row that is read last wins: of equal right rows the first by tie
    ties = [F.col(f"_right.{c}").desc_nulls_first() for c in tie]
    side = F.col("_side").asc() if allow_exact else F.col("_side").desc()
    seen = Window.partitionBy(*keys).orderBy(time, side, *ties).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = union.withColumn("_found", F.last("_right", ignorenulls=True).over(seen))
    if slice_by is not None:
        # each slice's right row that is nearest to the other slices, carried on to those without one
        edge = Window.partitionBy(*keys).orderBy(F.col("_ts").asc() if forward else F.col("_ts").desc(), *(F.col(f"_right.{c}").asc_nulls_last() for c in tie))
        nearest = union.where("_side = 0").withColumn("_n", F.row_number().over(edge)).where("_n = 1").select(*keys, F.col("_right").alias("_near"))
        order = F.col("_slice").desc_nulls_last() if forward else F.col("_slice").asc_nulls_first()
        earlier = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        slices = union.select(*keys).distinct().join(nearest, keys, "left")
        carried = slices.select(*keys, F.last("_near", ignorenulls=True).over(earlier).alias("_carried"))
        found = found.where("_side = 1").join(carried, keys, "left").withColumn("_found", F.coalesce("_found", "_carried"))
    match = F.when(F.col("_ts").isNotNull(), F.col("_found"))
    for c in by:
        match = F.when(F.col(f"_left.{c}").isNotNull(), match)
    # a key that was read as itself tells the planner that rows are partitioned by it already
    same = [c for c in by if union.schema[c].dataType == left.schema[c].dataType]
    told = [F.col(c) if c in same else F.col("_left")[c].alias(c) for c in left.columns]
    return found.where("_side = 1").select(*told, match.alias("_match")).select(*left.columns, *(F.col("_match")[c].alias(c) for c in extra))


def overlap_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_span: tuple[str, str], right_span: tuple[str, str], how: str = "left", slice_days: int | None = None) -> DataFrame:
    """Spans of the same key that overlap: left start < right end, and left end >= right start.

    With ``slice_days`` a span of a key with more than SLICED_ROWS right spans is also keyed by the slices of time it touches, which splits such keys;
    a pair counts in the first slice that both touch, so none is doubled. Other keys need no copies. These keys are counted first, so
    their number is bounded by the right side's rows divided by SLICED_ROWS. Column names of the two sides must differ but for ``by``.
    """
    (a, b), (x, y) = left_span, right_span
    meets = (F.col(a) < F.col(y)) & (F.col(b) >= F.col(x))
    if slice_days is None:
        other = right
        for c in by:
            other = other.withColumnRenamed(c, f"_r_{c}")
        on = meets
        for c in by:
            on &= F.col(c) == F.col(f"_r_{c}")
        return left.join(other, on, how).drop(*(f"_r_{c}" for c in by))

    def slot(c: str) -> Column:
        return F.floor(F.unix_date(F.col(c).cast("date")) / F.lit(slice_days))

    keys = list(by)
    many = right.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > SLICED_ROWS).select(*keys, F.lit(True).alias("_many"))

    def cut(df: DataFrame, from_: str, to: str) -> DataFrame:
        touched = F.sequence(F.least(slot(from_), slot(to)), F.greatest(slot(from_), slot(to)))
        marked = df.join(F.broadcast(many), keys, "left")
        return marked.withColumn("_slice", F.explode(F.when(F.col("_many"), touched).otherwise(F.array(F.lit(0).cast("long")))))

    other = cut(right, x, y).drop("_many").withColumnsRenamed({c: f"_r_{c}" for c in (*keys, "_slice")}).withColumn("_hit", F.lit(True))
    first = F.when(F.col("_many"), F.greatest(F.least(slot(a), slot(b)), F.least(slot(x), slot(y)))).otherwise(0)
    on = meets & (F.col("_slice") == first)
    for c in (*keys, "_slice"):
        on &= F.col(c) == F.col(f"_r_{c}")
    pairs = cut(left, a, b).join(other, on, how)
    extra = [c for c in right.columns if c not in keys]
    if how == "inner":
        return pairs.select(*left.columns, *extra)
    # a copy without a pair tells nothing of the other copies
    pairs = pairs.where("_hit OR _many IS NULL").select(*left.columns, *extra)
    few = [side.join(F.broadcast(many.drop("_many")), keys, "left_semi") for side in (left, right)]
    return pairs.unionByName(_without_overlap(*few, keys, left_span, right_span), allowMissingColumns=True)


def _without_overlap(left: DataFrame, right: DataFrame, by: list[str], left_span: tuple[str, str], right_span: tuple[str, str]) -> DataFrame:
    """Left rows that no right span of their key overlaps: of the right ones that start at their end or before, the latest end is not after their start.

    One running window over the union of both sides: neither side is copied and no pairs are compared.
    """
    (a, b), (x, y) = left_span, right_span
    starts = right.dropna(subset=[*by, x, y]).select(*by, F.col(x).alias("_at"), F.lit(0).alias("_side"), F.col(y).alias("_stop"))
    rows = left.select(*by, F.col(b).alias("_at"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_left"))
    so_far = Window.partitionBy(*by).orderBy(F.col("_at").asc_nulls_first(), "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = rows.unionByName(starts, allowMissingColumns=True).withColumn("_latest", F.max("_stop").over(so_far)).where("_side = 1")
    known = F.col("_at").isNotNull()
    for c in by:
        known &= F.col(c).isNotNull()
    return found.where(~F.coalesce(known & (F.col("_latest") > F.col(f"_left.{a}")), F.lit(False))).select("_left.*")


def clip(start: Column, end: Column, low: Column, high: Column) -> tuple[Column, Column]:
    """The part of a span that lies within another; a null bound doesn't clip."""
    return F.greatest(start, low), F.least(end, high)


def either_key(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """A row for each distinct value of several key columns, so that a join on any of them is a join on one."""
    return df.withColumn(name, F.explode(F.array_distinct(F.array(*keys)))).where(F.col(name).isNotNull())


def count_between(spans: DataFrame, points: DataFrame, by: Sequence[str], start: str, end: str, at: str, what: str, name: str, slice_days: int | None = None) -> DataFrame:
    """Spans with the number of distinct ``what`` of points of their key in (start, end]; spans without any are left out, equal ones are one row.

    No span meets all its points: one running count of a key's points gives those up to the end and up to the start. A ``what`` that
    was there at an earlier time of the same span, too, is taken off again, by a join with those that have several times.
    ``slice_days`` cuts keys that hold very many rows into slices of time, each counted apart and added up.
    """
    keys = list(by)
    span = F.struct(*spans.columns).alias("_span")
    spans, points = spans.dropna(subset=[*keys, start, end]), points.dropna(subset=[*keys, at, what])
    before = F.lag(at).over(Window.partitionBy(*keys, what).orderBy(at))
    seen = points.select(*keys, F.col(at).alias("_at"), before.alias("_before")).where("_before IS NULL OR _before < _at")
    ends = F.inline(F.array(F.struct(F.col(start).alias("_at"), F.lit(-1).alias("_sign")), F.struct(F.col(end).alias("_at"), F.lit(1).alias("_sign"))))
    edges = spans.select(*keys, span, ends).withColumn("_point", F.lit(0))
    rows = edges.unionByName(seen.select(*keys, "_at", F.lit(0).alias("_sign"), F.lit(1).alias("_point")), allowMissingColumns=True)
    group = list(keys)
    if slice_days is not None:
        rows = rows.withColumn("_slice", F.floor(F.unix_date(F.col("_at").cast("date")) / F.lit(slice_days)))
        group.append("_slice")
    up_to = Window.partitionBy(*group).orderBy("_at", F.col("_point").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = rows.withColumn("_n", F.sum("_point").over(up_to)).where("_sign <> 0")
    if slice_days is not None:
        earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        carried = rows.groupBy(*group).agg(F.sum("_point").alias("_own")).select(*group, F.coalesce(F.sum("_own").over(earlier), F.lit(0)).alias("_carried"))
        counted = counted.join(carried, group).withColumn("_n", F.col("_n") + F.col("_carried"))
    counts = counted.select("_span", (F.col("_n") * F.col("_sign")).alias("_n"), (F.col("_sign") > 0).cast("int").alias("_ends"))
    repeated = seen.where("_before IS NOT NULL")
    again = spans.select(*keys, span).join(repeated, keys).where((F.col("_before") > F.col(f"_span.{start}")) & (F.col("_at") <= F.col(f"_span.{end}")))
    counts = counts.unionByName(again.select("_span", F.lit(-1).cast("long").alias("_n"), F.lit(0).alias("_ends")))
    # an equal span has its ends and its repeats as often as it stands there
    total = counts.groupBy("_span").agg((F.sum("_n") / F.sum("_ends")).cast("long").alias(name))
    return total.where(F.col(name) > 0).select("_span.*", name)


def first_match(left: DataFrame, right: DataFrame, left_keys: Sequence[Column], right_keys: Sequence[Column], identity: Sequence[str], tie: Sequence[str]) -> DataFrame:
    """A left join on any pair of several candidate keys of both sides; the pair that is first in order wins.

    Candidates become rows with their priority, so the join is by equality. Of the right rows of a key only the first by priority and ``tie`` can win,
    so the right side is one row a key before it is joined.
    """

    def spread(df: DataFrame, keys: Sequence[Column], place: str) -> DataFrame:
        listed = F.posexplode(F.array(*(k.cast("string") for k in keys)))
        return df.select("*", listed.alias(place, "_key")).where("_key IS NOT NULL AND _key <> ''")

    extra = [c for c in right.columns if c not in left.columns]
    first = keep_first(spread(right, right_keys, "_j"), ["_key"], ["_j", *(c for c in tie if c in right.columns)]).select("_key", *extra)
    pairs = spread(left, left_keys, "_i").select(*identity, "_i", "_key").join(first, "_key")
    best = Window.partitionBy(*identity).orderBy("_i")
    chosen = pairs.withColumn("_n", F.row_number().over(best)).where("_n = 1").select(*identity, *extra)
    return left.join(chosen, list(identity), "left")


def fill_wanted(counts: DataFrame, key: str, wanted: Sequence[str], values: Sequence[str]) -> DataFrame:
    """A row for each wanted category in turn, with zeros where nothing was counted."""
    names = counts.sparkSession.createDataFrame([(w,) for w in wanted], f"{key} string")
    return names.join(counts, key, "left").fillna(0, subset=list(values))
