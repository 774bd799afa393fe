"""Windows on the shared tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from spanweave.operators.checks import overlapping
from spanweave.operators.windows import changed, island_ids, keep_fewest_nulls, keep_first, lag_deltas, last_in_group, last_known, recent, recent_mean, recent_slope, recent_stddev
from spanweave.plans.catalog import register, table
from spanweave.plans.outings import horizon_labels

_ISLANDS = """i AS (
    SELECT *, sum(CASE WHEN coalesce(prev, false) THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island
    FROM (SELECT *, lag(bridge) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM (
        SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= ts + INTERVAL 6 HOUR AS bridge FROM events)))"""


def _islands(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    near = F.lead("ts").over(w) <= F.col("ts") + F.expr("INTERVAL 6 HOURS")
    return island_ids(events.withColumn("near", near), ["user_id"], ["ts", "event_id"], F.col("near")).drop("near")


@register("islands_bridge", f"WITH {_ISLANDS} SELECT event_id, user_id, CAST(island AS BIGINT) AS island FROM i")
def islands_bridge(spark, sf_dir):
    return _islands(spark, sf_dir).select("event_id", "user_id", "island")


@register(
    "islands_collapsed",
    f"""
    WITH {_ISLANDS}
    SELECT user_id, CAST(island AS BIGINT) AS island, min(ts) AS first_ts, max(ts) AS last_ts, CAST(count(*) AS BIGINT) AS n_events,
           arg_max(event_type, (ts, event_id)) AS last_type,
           coalesce(arg_max(event_type, (ts, event_id)) FILTER (event_type IN ('error', 'purchase')), arg_max(event_type, (ts, event_id))) AS carried_type
    FROM i GROUP BY 1, 2
    """,
)
def islands_collapsed(spark, sf_dir):
    place = F.struct("ts", "event_id")
    severe = F.when(F.col("event_type").isin("error", "purchase"), F.struct("ts", "event_id", "event_type"))
    return _islands(spark, sf_dir).groupBy("user_id", "island").agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count("*").alias("n_events"), F.max_by("event_type", place).alias("last_type"),
        F.coalesce(F.max(severe)["event_type"], F.max_by("event_type", place)).alias("carried_type"),
    )


@register(
    "ffill_last_known",
    """
    SELECT event_id, user_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (
        PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS last_purchase FROM events
    """,
)
def ffill_last_known(spark, sf_dir):
    bought = F.when(F.col("event_type") == "purchase", F.col("value"))
    return table(spark, sf_dir, "events").select("event_id", "user_id", last_known(bought, ["user_id"], ["ts", "event_id"]).alias("last_purchase"))


@register(
    "last_in_group",
    "SELECT event_id, user_id, last_value(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_type FROM events",
)
def last_of_user(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "user_id", last_in_group("event_type", ["user_id"], ["ts", "event_id"]).alias("last_type"))


@register(
    "shared_key_reset",
    """
    SELECT o_orderkey, CASE WHEN count(*) OVER w > 1 AND o_orderkey = min(o_orderkey) OVER w THEN NULL ELSE CAST(o_orderdate AS DATE) END AS kept_date
    FROM orders WINDOW w AS (PARTITION BY o_custkey, CAST(o_orderdate AS DATE))
    """,
)
def shared_key_reset(spark, sf_dir):
    day = F.to_date("o_orderdate")
    w = Window.partitionBy("o_custkey", day)
    lost = (F.count("*").over(w) > 1) & (F.col("o_orderkey") == F.min("o_orderkey").over(w))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.when(~lost, day).alias("kept_date"))


@register(
    "dedup_latest",
    "SELECT user_id, event_id, ts, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, value DESC NULLS LAST, event_id DESC) AS n FROM events) WHERE n = 1",
)
def dedup_latest(spark, sf_dir):
    order = [F.col("ts").desc_nulls_last(), F.col("value").desc_nulls_last(), F.col("event_id").desc()]
    return keep_first(table(spark, sf_dir, "events"), ["user_id"], order).select("user_id", "event_id", "ts", "event_type")


@register(
    "dedup_fewest_nulls",
    """
    WITH e AS (SELECT user_id, event_id, CASE WHEN event_type = 'view' THEN NULL ELSE event_type END AS kind, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS v FROM events)
    SELECT user_id, event_id, kind, v FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY (CASE WHEN kind IS NULL THEN 1 ELSE 0 END) + (CASE WHEN v IS NULL THEN 1 ELSE 0 END), event_id) AS n FROM e) WHERE n = 1
    """,
)
def dedup_fewest_nulls(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        "user_id", "event_id", F.when(F.col("event_type") != "view", F.col("event_type")).alias("kind"), F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("v")
    )
    return keep_fewest_nulls(rows, ["user_id"], [F.col("event_id").asc()])


@register(
    "role_by_first_in_group",
    """
    WITH f AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_linenumber, l_partkey, l_extendedprice) = 1 AS first FROM lineitem),
    r AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_extendedprice, CASE WHEN first THEN 'starter' ELSE 'reliever' END AS role FROM f)
    SELECT l_orderkey, l_linenumber, role, CASE WHEN role = lag(role) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) THEN false ELSE true END AS role_switch FROM r
    """,
)
def role_by_first_in_group(spark, sf_dir):
    first = F.row_number().over(Window.partitionBy("l_orderkey", "l_returnflag").orderBy("l_linenumber", "l_partkey", "l_extendedprice")) == 1
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_extendedprice", F.when(first, "starter").otherwise("reliever").alias("role"))
    return rows.select("l_orderkey", "l_linenumber", "role", changed("role", ["l_suppkey"], ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]).alias("role_switch"))


@register(
    "sequence_number",
    "SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderdate, o_orderkey) AS INTEGER) AS order_number FROM orders",
)
def sequence_number(spark, sf_dir):
    w = Window.partitionBy("o_custkey", F.year("o_orderdate")).orderBy("o_orderdate", "o_orderkey")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.row_number().over(w).alias("order_number"))


@register(
    "lag_gap_days",
    """
    SELECT o_custkey, d, n_orders, CAST(d - lag(d) OVER (PARTITION BY o_custkey ORDER BY d) AS INTEGER) AS gap_days
    FROM (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, CAST(count(*) AS BIGINT) AS n_orders FROM orders GROUP BY 1, 2)
    """,
)
def lag_gap_days(spark, sf_dir):
    days = table(spark, sf_dir, "orders").groupBy("o_custkey", F.to_date("o_orderdate").alias("d")).agg(F.count("*").alias("n_orders"))
    return days.withColumn("gap_days", F.datediff("d", F.lag("d").over(Window.partitionBy("o_custkey").orderBy("d"))))


@register(
    "horizon_labels_7_30d",
    """
    WITH v AS (SELECT event_id, user_id, CAST(ts AS DATE) AS d FROM events WHERE event_type = 'view'),
    e AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS hit FROM events WHERE event_type = 'error'),
    n AS (SELECT v.*, e.hit FROM v ASOF LEFT JOIN e ON v.user_id = e.user_id AND v.d <= e.hit)
    SELECT event_id, user_id, CASE WHEN hit - d <= 30 THEN hit END AS hit, hit IS NOT NULL AND hit - d <= 30 AND row_number() OVER (PARTITION BY user_id, hit ORDER BY d DESC, event_id DESC) = 1 AS last_before,
           coalesce(hit - d <= 7, false) AS within_7d, coalesce(hit - d <= 30, false) AS within_30d FROM n
    """,
)
def horizon_labels_7_30d(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("d", F.to_date("ts"))
    views = events.where("event_type = 'view'").select("event_id", "user_id", "d")
    errors = events.where("event_type = 'error'").select("user_id", F.col("d").alias("hit")).distinct()
    return horizon_labels(views, errors, "user_id", "d", "hit", [7, 30], ["event_id"]).drop("d")


_HISTORY = """h AS (
    SELECT a.event_id, b.value, row_number() OVER (PARTITION BY a.event_id ORDER BY b.n DESC) AS rn
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events) a
    JOIN (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events) b ON a.user_id = b.user_id AND b.n < a.n AND b.n >= a.n - 5)"""


@register(
    "last_n_rollup_slope",
    f"""
    WITH {_HISTORY}
    SELECT e.event_id, CAST(coalesce(n, 0) AS INTEGER) AS n_history, round(m, 6) AS mean_5, round(s, 6) AS std_4, round(k, 6) AS slope_5
    FROM events e LEFT JOIN (SELECT event_id, count(*) AS n, avg(value) AS m, stddev_pop(value) FILTER (rn <= 4) AS s,
        CASE WHEN count(value) > 1 THEN regr_slope(value, rn) END AS k FROM h GROUP BY 1) USING (event_id)
    """,
)
def last_n_rollup_slope(spark, sf_dir):
    rows = recent(table(spark, sf_dir, "events"), ["value"], ["user_id"], ["ts", "event_id"], 5)
    h = F.col("history")
    return rows.select(
        "event_id", F.size(h).alias("n_history"), F.round(recent_mean(h, "value", 5), 6).alias("mean_5"), F.round(recent_stddev(h, "value", 4), 6).alias("std_4"), F.round(recent_slope(h, "value", 5), 6).alias("slope_5")
    )


@register(
    "last_n_json",
    f"""
    WITH {_HISTORY}
    SELECT e.event_id, CAST(coalesce(n, 0) AS INTEGER) AS n_history, first_value AS newest
    FROM events e LEFT JOIN (SELECT event_id, count(*) AS n, max(value) FILTER (rn = 1) AS first_value FROM h GROUP BY 1) USING (event_id)
    """,
)
def last_n_json(spark, sf_dir):
    rows = recent(table(spark, sf_dir, "events"), ["value"], ["user_id"], ["ts", "event_id"], 5)
    parsed = F.from_json(F.to_json("history"), "array<struct<rn:int,value:double>>")
    return rows.select("event_id", F.size(parsed).alias("n_history"), F.try_element_at(parsed, F.lit(1))["value"].alias("newest"))


@register(
    "metric_deltas",
    """
    SELECT l_suppkey, l_orderkey, l_linenumber, l_quantity - lag(l_quantity) OVER w AS l_quantity_delta, l_tax - lag(l_tax) OVER w AS l_tax_delta
    FROM lineitem WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice)
    """,
)
def metric_deltas(spark, sf_dir):
    rows = lag_deltas(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_tax"], ["l_suppkey"], ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"])
    return rows.select("l_suppkey", "l_orderkey", "l_linenumber", "l_quantity_delta", "l_tax_delta")


@register(
    "mutually_exclusive_ranges_check",
    """
    SELECT o_orderkey, a, next_start FROM (SELECT o_orderkey, a, b, lead(a) OVER (PARTITION BY o_custkey ORDER BY a, b, o_orderkey) AS next_start
        FROM (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS a, CASE WHEN o_orderstatus = 'O' THEN DATE '9999-12-31' ELSE CAST(o_orderdate AS DATE) + 30 END AS b FROM orders))
    WHERE next_start < b
    """,
)
def mutually_exclusive_ranges_check(spark, sf_dir):
    day = F.to_date("o_orderdate")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", day.alias("a"), F.when(F.col("o_orderstatus") != "O", F.date_add(day, 30)).alias("b"))
    w_end = F.coalesce("b", F.lit("9999-12-31").cast("date"))
    return overlapping(rows, ["o_custkey"], "a", w_end).select("o_orderkey", "a", "next_start")


_AS_GAMES = """games AS (
    SELECT o_orderkey AS gamepk, CAST(year(o_orderdate) AS INTEGER) AS season, CAST(o_orderdate AS DATE) AS gamedate, o_orderstatus AS gametype,
           CAST(o_custkey % 7 AS BIGINT) AS home, CAST(o_custkey % 5 + 1 AS BIGINT) AS away FROM orders),
    played AS (SELECT gamepk, season, gamedate, gametype, home AS team_id FROM games UNION SELECT gamepk, season, gamedate, gametype, away FROM games)"""


def _games(spark, sf_dir):
    """Orders as games between two of a few teams."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("gamepk"), F.year("o_orderdate").alias("season"), F.to_date("o_orderdate").alias("gamedate"), F.col("o_orderstatus").alias("gametype"),
        (F.col("o_custkey") % 7).alias("home_team_id"), (F.col("o_custkey") % 5 + 1).alias("away_team_id"),
    )


@register(
    "season_calendar",
    f"""
    WITH {_AS_GAMES}
    SELECT team_id, season, min(gamedate) AS first_game, CASE WHEN season = 1998 THEN NULL ELSE max(gamedate) END AS last_game
    FROM played WHERE gametype <> 'P' AND team_id IN (1, 2, 3, 4) GROUP BY 1, 2
    """,
)
def season_calendar(spark, sf_dir):
    from spanweave.plans.spans import season_calendar as calendar

    teams = spark.createDataFrame([(i,) for i in (1, 2, 3, 4)], "id long")
    return calendar(_games(spark, sf_dir), teams, F.lit("1998-06-01").cast("date"), ("P",)).select("team_id", "season", "first_game", "last_game")


@register(
    "team_game_numbers",
    f"WITH {_AS_GAMES} SELECT gamepk, season, team_id, gamedate, CAST(row_number() OVER (PARTITION BY season, team_id ORDER BY gamedate, gamepk) AS INTEGER) AS team_game_number FROM played",
)
def team_game_numbers(spark, sf_dir):
    from spanweave.plans.outings import team_game_numbers as numbers

    return numbers(_games(spark, sf_dir))


@register(
    "games_in_span",
    f"""
    WITH {_AS_GAMES}, slices AS (SELECT o_orderkey AS span, CAST(o_custkey % 7 AS BIGINT) AS team_id, CAST(year(o_orderdate) AS INTEGER) AS season,
        CAST(o_orderdate AS DATE) AS a, CAST(o_orderdate AS DATE) + 10 AS b FROM orders)
    SELECT span, CAST(count(DISTINCT gamepk) AS BIGINT) AS games_missed FROM slices s JOIN played p ON s.team_id = p.team_id AND s.season = p.season AND gamedate > a AND gamedate <= b
    WHERE gametype = 'F' GROUP BY 1
    """,
)
def games_in_span(spark, sf_dir):
    from spanweave.plans.spans import games_missed

    day = F.to_date("o_orderdate")
    slices = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("span"), (F.col("o_custkey") % 7).alias("team_id"), F.year("o_orderdate").alias("season"), day.alias("start_date"), F.date_add(day, 10).alias("end_date")
    )
    return games_missed(slices, _games(spark, sf_dir)).select("span", "games_missed")
