"""Outings, their labels and history, and the report tables, through the functions of ``outings`` and ``reports``."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanweave.operators import facets
from spanweave.plans import outings as O
from spanweave.plans import reports as R
from spanweave.plans.catalog import register, table


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn("d", F.to_date("ts"))


@register(
    "outing_metrics",
    """
    WITH g AS (SELECT l_suppkey, l_orderkey, CAST(l_shipdate AS DATE) AS d, CAST(count(DISTINCT l_partkey) AS BIGINT) AS n_l_partkey, round(avg(l_quantity), 6) AS avg_l_quantity, round(stddev_pop(l_quantity), 6) AS std_l_quantity,
        md5(l_suppkey || '-' || l_orderkey) AS outing_id FROM lineitem GROUP BY 1, 2, 3)
    SELECT *, CAST(d - lag(d) OVER (PARTITION BY l_suppkey ORDER BY d, l_orderkey) AS INTEGER) AS days_since FROM g
    """,
)
def outing_metrics(spark, sf_dir):
    rows = O.outings(table(spark, sf_dir, "lineitem").withColumn("d", F.to_date("l_shipdate")), ["l_suppkey", "l_orderkey"], "d", ["l_quantity"], "l_partkey")
    return rows.withColumns({c: F.round(c, 6) for c in ("avg_l_quantity", "std_l_quantity")})


@register(
    "outing_roles",
    """
    WITH f AS (SELECT DISTINCT l_orderkey, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_linenumber, l_suppkey) AS n FROM lineitem) WHERE n = 1),
    o AS (SELECT l_suppkey, l_orderkey, min(CAST(l_shipdate AS DATE)) AS d FROM lineitem GROUP BY 1, 2),
    r AS (SELECT o.*, CASE WHEN f.l_orderkey IS NOT NULL THEN 'starter' ELSE 'reliever' END AS role FROM o LEFT JOIN f ON o.l_orderkey = f.l_orderkey AND o.l_suppkey = f.l_suppkey)
    SELECT *, coalesce(role <> lag(role) OVER (PARTITION BY l_suppkey ORDER BY d, l_orderkey), true) AS role_switch FROM r
    """,
)
def outing_roles(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    rows = lines.groupBy("l_suppkey", "l_orderkey").agg(F.min(F.to_date("l_shipdate")).alias("d"))
    return O.roles(rows, lines, "l_orderkey", "l_returnflag", "l_suppkey", ["l_linenumber", "l_suppkey"], "d")


@register(
    "outing_labels",
    """
    WITH v AS (SELECT event_id, user_id, CAST(ts AS DATE) AS d FROM events WHERE event_type <> 'error'),
    e AS (SELECT user_id, CAST(ts AS DATE) AS hit, max(event_id) AS span, max(value) > 20 AS severe FROM events WHERE event_type = 'error' AND value > 15 GROUP BY 1, 2),
    n AS (SELECT v.*, hit, span, severe, coalesce(hit - d <= 7, false) AS w7, coalesce(hit - d <= 10, false) AS w10 FROM v ASOF LEFT JOIN e ON v.user_id = e.user_id AND v.d <= e.hit),
    l AS (SELECT *, hit IS NOT NULL AND w10 AND row_number() OVER (PARTITION BY user_id, hit ORDER BY d DESC, event_id DESC) = 1 AS last_before, coalesce(severe, false) AS s FROM n)
    SELECT event_id, last_before, w7 AS within_7d, w10 AS within_10d, last_before AND s AS last_before_arm, w7 AND s AS within_7d_arm, w10 AND s AS within_10d_arm,
           CASE WHEN w10 THEN hit END AS hit, CASE WHEN w10 THEN span END AS span FROM l
    """,
)
def outing_labels(spark, sf_dir):
    rows = _events(spark, sf_dir)
    hits = rows.where("event_type = 'error' AND value > 15").groupBy("user_id", F.col("d").alias("hit")).agg(F.max("event_id").alias("span"), (F.max("value") > 20).alias("severe"))
    out = O.horizon_labels(rows.where("event_type <> 'error'").select("event_id", "user_id", "d"), hits, "user_id", "d", "hit", [7, 10], ["event_id"], F.col("severe"))
    return out.drop("user_id", "d", "severe")


@register(
    "outing_history",
    """
    WITH e AS (SELECT event_id, user_id, CAST(ts AS DATE) AS d, value, event_type = 'error' AS switch, value - lag(value) OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE), event_id) AS delta FROM events),
    n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY d, event_id) AS n, count(*) OVER (PARTITION BY user_id ORDER BY d RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - count(*) OVER (PARTITION BY user_id, d) AS earlier FROM e),
    h AS (SELECT a.event_id, b.event_id AS other, b.value, b.delta, b.switch, a.earlier - b.n + 1 AS rn FROM n a JOIN n b ON a.user_id = b.user_id AND b.n <= a.earlier AND b.n > a.earlier - 5)
    SELECT event_id, CAST(coalesce(k, 0) AS INTEGER) AS n_history, round(m, 6) AS value_mean_5, round(s, 6) AS value_std_5, round(r, 6) AS value_slope_5, round(a, 6) AS value_avg_delta_5, CAST(coalesce(w, 0) AS INTEGER) AS role_switch_count,
           CAST(coalesce(k, 0) >= 1 AS INTEGER) AS has_outing_t_1, CAST(coalesce(k, 0) >= 2 AS INTEGER) AS has_outing_t_2, CAST(coalesce(k, 0) >= 3 AS INTEGER) AS has_outing_t_3, CAST(coalesce(k, 0) >= 4 AS INTEGER) AS has_outing_t_4,
           CAST(coalesce(k, 0) >= 5 AS INTEGER) AS has_outing_t_5, coalesce(js, '') AS listed
    FROM events LEFT JOIN (SELECT event_id, count(*) AS k, avg(value) AS m, stddev_pop(value) FILTER (rn <= 4) AS s, CASE WHEN count(value) > 1 THEN regr_slope(value, rn) END AS r, avg(delta) FILTER (rn <= 4) AS a,
        count(*) FILTER (rn <= 4 AND switch) AS w, string_agg(rn || ':' || other || ':' || switch || ':' || (delta IS NULL), ';' ORDER BY rn) AS js FROM h GROUP BY 1) USING (event_id)
    """,
)
def outing_history(spark, sf_dir):
    """All features of the last five, and the JSON read again, element by element."""
    rows = _events(spark, sf_dir).select("event_id", "user_id", "d", "value", (F.col("event_type") == "error").alias("switch"), F.col("event_id").alias("other"))
    out = O.history_features(rows, "user_id", ["d", "event_id"], ["value"], 5, "switch", ["other"])
    parsed = F.from_json("history_json", "array<struct<rn:int,other:long,switch:boolean,value:double,value_delta:double>>")
    text = F.transform(parsed, lambda x: F.concat_ws(":", x["rn"], x["other"], x["switch"], x["value_delta"].isNull()))
    features = [F.round(f"value_{f}_5", 6).alias(f"value_{f}_5") for f in ("mean", "std", "slope", "avg_delta")]
    return out.select("event_id", "n_history", *features, "role_switch_count", *(f"has_outing_t_{i}" for i in range(1, 6)), F.array_join(text, ";").alias("listed"))


@register(
    "outing_prior_spans",
    """
    WITH s AS (SELECT user_id, CAST(ts AS DATE) AS hit, CAST(max(event_id) AS BIGINT) AS games FROM events WHERE event_type = 'error' GROUP BY 1, 2),
    j AS (SELECT e.event_id, CAST(e.ts AS DATE) - hit AS days, games, row_number() OVER (PARTITION BY e.event_id ORDER BY hit DESC) AS rn FROM events e JOIN s ON e.user_id = s.user_id AND s.hit < CAST(e.ts AS DATE))
    SELECT event_id, CAST(m AS INTEGER) AS days_since_last_injury, coalesce(t, '') AS listed
    FROM events LEFT JOIN (SELECT event_id, min(days) AS m, string_agg(rn || ':' || days || ':' || games, ';' ORDER BY rn) FILTER (rn <= 5) AS t FROM j GROUP BY 1) USING (event_id)
    """,
)
def outing_prior_spans(spark, sf_dir):
    rows = _events(spark, sf_dir)
    spans = rows.where("event_type = 'error'").groupBy("user_id", F.col("d").alias("hit")).agg(F.max("event_id").alias("games"))
    out = O.prior_spans(rows.select("event_id", "user_id", "d"), spans, "user_id", "d", "hit", ["games"])
    parsed = F.from_json("injuries_json", "array<struct<rn:int,days_since_injury:int,games:long>>")
    return out.select("event_id", "days_since_last_injury", F.array_join(F.transform(parsed, lambda x: F.concat_ws(":", x["rn"], x["days_since_injury"], x["games"])), ";").alias("listed"))


@register(
    "outing_static_features",
    """
    WITH o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS d, CAST(o_orderdate AS DATE) - lag(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS gap FROM orders),
    p AS (SELECT c_custkey, DATE '1970-01-01' + CAST(c_custkey % 9000 AS INTEGER) AS birth, 150.0 + c_custkey % 100 AS weight, 66 + c_custkey % 12 AS height FROM customer)
    SELECT o_orderkey, CAST(CASE WHEN gap <= 30 THEN gap END AS INTEGER) AS days_since, round((d - birth) / 365.25, 6) AS age, round(weight / (height * height) * 703, 6) AS bmi, l_n, CAST(CASE WHEN l_n > 3 THEN l_q END AS DOUBLE) AS quantity
    FROM o LEFT JOIN p ON o_custkey = c_custkey LEFT JOIN (SELECT l_orderkey, CAST(count(*) AS BIGINT) AS l_n, sum(l_quantity) AS l_q FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey
    """,
)
def outing_static_features(spark, sf_dir):
    from pyspark.sql import Window

    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("d"))
    before = F.lag("d").over(Window.partitionBy("o_custkey").orderBy("d", "o_orderkey"))
    number = F.col("c_custkey")
    people = table(spark, sf_dir, "customer").select(number.alias("o_custkey"), F.expr("date_add(DATE'1970-01-01', CAST(c_custkey % 9000 AS INT))").alias("birth"), (150.0 + number % 100).alias("weight"), (66 + number % 12).alias("height"))
    rows = O.static_features(orders.withColumn("days_since", F.datediff("d", before)), people, "o_custkey", "d", "birth")
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("l_n"), F.sum("l_quantity").alias("l_q"))
    out = O.assembled(rows, "o_orderkey", lines.select("o_orderkey", "l_n"), lines.where("l_n > 3").select("o_orderkey", F.col("l_q").alias("quantity")))
    return out.select("o_orderkey", "days_since", F.round("age", 6).alias("age"), F.round("bmi", 6).alias("bmi"), "l_n", "quantity")


_REPORT = """rep AS (SELECT l_orderkey AS person_id, 'p' || CAST(l_suppkey AS VARCHAR) AS name, 't' || CAST(l_partkey % 30 AS VARCHAR) AS team, CAST(year(l_shipdate) AS INTEGER) AS season, CASE l_linenumber % 4 WHEN 0 THEN NULL WHEN 1 THEN 'elbow' WHEN 2 THEN 'knee' ELSE 'head' END AS body_part_group,
    CASE l_linenumber % 3 WHEN 0 THEN NULL ELSE l_returnflag END AS body_part, l_linestatus AS injury_type, CAST(l_quantity AS BIGINT) AS games_missed, CAST(l_extendedprice AS DECIMAL(18,2)) AS injured_salary, CAST(l_tax AS DECIMAL(18,2)) AS war_missed,
    CAST(l_shipdate AS DATE) AS start_date, CAST(l_shipdate AS DATE) + l_linenumber AS end_date, CAST(l_linenumber AS BIGINT) AS days_injured, l_orderkey || '-' || (l_linenumber % 3) AS injury_span_sk, l_linenumber = 1 AS currently_injured, l_linenumber, l_partkey FROM lineitem)"""
_SUMS = "CAST(sum(games_missed) AS BIGINT) AS games_missed, CAST(count(*) AS BIGINT) AS injury_count, CAST(sum(injured_salary) AS DOUBLE) AS injured_salary, CAST(sum(war_missed) AS DOUBLE) AS war_missed"


def _report(spark, sf_dir):
    line = F.col("l_linenumber")
    day = F.to_date("l_shipdate")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("person_id"), F.concat(F.lit("p"), F.col("l_suppkey").cast("string")).alias("name"), F.concat(F.lit("t"), (F.col("l_partkey") % 30).cast("string")).alias("team"), F.year("l_shipdate").alias("season"),
        F.when(line % 4 == 1, "elbow").when(line % 4 == 2, "knee").when(line % 4 == 3, "head").alias("body_part_group"), F.when(line % 3 != 0, F.col("l_returnflag")).alias("body_part"), F.col("l_linestatus").alias("injury_type"),
        F.col("l_quantity").cast("long").alias("games_missed"), F.col("l_extendedprice").cast("decimal(18,2)").alias("injured_salary"), F.col("l_tax").cast("decimal(18,2)").alias("war_missed"),
        day.alias("start_date"), F.date_add(day, line).alias("end_date"), line.cast("long").alias("days_injured"), F.concat_ws("-", "l_orderkey", line % 3).alias("injury_span_sk"), (line == 1).alias("currently_injured"), line, "l_partkey",
    )


def _doubles(df):
    return df.withColumns({c: F.col(c).cast("double") for c in ("injured_salary", "war_missed") if c in df.columns})


@register("league_summary", f"WITH {_REPORT}, d AS (SELECT * FROM rep WHERE body_part_group IS NOT NULL) SELECT body_part_group, {_SUMS} FROM d GROUP BY 1 UNION ALL SELECT 'Total', {_SUMS} FROM d")
def league_summary(spark, sf_dir):
    return _doubles(R.league_summary(_report(spark, sf_dir), "body_part_group"))


@register(
    "league_table_places",
    f"""
    WITH {_REPORT}, g AS (SELECT season, body_part_group, CAST(sum(games_missed) AS BIGINT) AS games_missed FROM rep WHERE body_part_group IN ('elbow', 'knee') AND team <> 't3' GROUP BY 1, 2)
    SELECT season, body_part_group, games_missed, CAST(a AS INTEGER) AS season_place, CAST(b AS INTEGER) AS body_part_group_place FROM g
    JOIN (SELECT season, row_number() OVER (ORDER BY sum(games_missed) DESC, season) AS a FROM g GROUP BY 1) USING (season) JOIN (SELECT body_part_group, row_number() OVER (ORDER BY sum(games_missed) DESC, body_part_group) AS b FROM g GROUP BY 1) USING (body_part_group)
    """,
)
def league_table_places(spark, sf_dir):
    chosen = facets.facet("body_part_group", ["elbow", "knee"], ["elbow", "knee", "head"])
    return R.league_table(_report(spark, sf_dir), [chosen, F.col("team") != "t3"], "season", "body_part_group", "games_missed")


@register(
    "team_top_players",
    f"""
    WITH {_REPORT}, top AS (SELECT name FROM rep GROUP BY 1 ORDER BY sum(games_missed) DESC, name LIMIT 5),
    g AS (SELECT body_part_group, CASE WHEN top.name IS NULL THEN 'Others' ELSE rep.name END AS name, games_missed, nullif(concat_ws(' ', body_part, injury_type), '') AS pair FROM rep LEFT JOIN top USING (name) WHERE body_part_group IS NOT NULL),
    s AS (SELECT body_part_group, name, CAST(sum(games_missed) AS BIGINT) AS games_missed, CASE WHEN name = 'Others' THEN '(multiple)' ELSE coalesce(string_agg(DISTINCT pair, '; ' ORDER BY pair), '—') END AS injuries FROM g GROUP BY 1, 2)
    SELECT s.*, CAST(place AS INTEGER) AS place FROM s JOIN (SELECT name, row_number() OVER (ORDER BY name = 'Others', sum(games_missed) DESC, name) AS place FROM s GROUP BY 1) USING (name)
    """,
)
def team_top_players(spark, sf_dir):
    return R.team_players(_report(spark, sf_dir), "games_missed", 5)


@register("team_summary_wanted", f"WITH {_REPORT}, w AS (SELECT unnest(['knee', 'elbow', 'wrist']) AS body_part_group) SELECT body_part_group, coalesce(games_missed, 0) AS games_missed, coalesce(injury_count, 0) AS injury_count, coalesce(injured_salary, 0) AS injured_salary, coalesce(war_missed, 0) AS war_missed FROM w LEFT JOIN (SELECT body_part_group, {_SUMS} FROM rep WHERE team = 't4' GROUP BY 1) USING (body_part_group)")
def team_summary_wanted(spark, sf_dir):
    return _doubles(R.team_summary(R.where_equal(_report(spark, sf_dir), team="t4"), "body_part_group", ["knee", "elbow", "wrist"]))


@register("player_seasons", f"WITH {_REPORT} SELECT season, {_SUMS}, CAST(sum(days_injured) AS BIGINT) AS days_injured FROM rep GROUP BY 1")
def player_seasons(spark, sf_dir):
    return _doubles(R.player_seasons(_report(spark, sf_dir)))


@register("player_body_parts", f"WITH {_REPORT} SELECT season, coalesce(body_part, 'Unknown') AS body_part, CAST(sum(games_missed) AS BIGINT) AS games_missed FROM rep GROUP BY 1, 2")
def player_body_parts(spark, sf_dir):
    return R.player_body_parts(_report(spark, sf_dir))


@register("player_totals", f"WITH {_REPORT} SELECT CAST(sum(games_missed) AS BIGINT) AS games_missed, CAST(sum(injured_salary) AS DOUBLE) AS injured_salary, CAST(sum(war_missed) AS DOUBLE) AS war_missed FROM rep WHERE name = 'p1'")
def player_totals(spark, sf_dir):
    return _doubles(R.player_totals(R.where_equal(_report(spark, sf_dir), name="p1")))


@register(
    "spans_folded",
    f"""
    WITH {_REPORT}, r AS (SELECT *, row_number() OVER (PARTITION BY injury_span_sk ORDER BY start_date, l_linenumber, l_partkey) AS n FROM rep)
    SELECT injury_span_sk, min(start_date) AS start_date, max(end_date) AS end_date, CAST(sum(games_missed) AS BIGINT) AS games_missed, CAST(sum(injured_salary) AS DOUBLE) AS injured_salary, CAST(sum(days_injured) AS BIGINT) AS days_injured,
           arg_min(body_part, (start_date, body_part)) FILTER (body_part IS NOT NULL) AS body_part, arg_min(body_part_group, (start_date, body_part_group)) FILTER (body_part_group IS NOT NULL) AS body_part_group, bool_or(currently_injured) AS currently_injured FROM r GROUP BY 1
    """,
)
def spans_folded(spark, sf_dir):
    """Of rows that begin on the same day the lower value comes first."""
    return _doubles(R.spans_folded(_report(spark, sf_dir))).select("injury_span_sk", "start_date", "end_date", "games_missed", "injured_salary", "days_injured", "body_part", "body_part_group", "currently_injured")


@register(
    "leaderboard_spans_by_function",
    f"WITH {_REPORT} SELECT injury_span_sk, l_linenumber, games_missed, CAST(injured_salary AS DOUBLE) AS injured_salary FROM rep ORDER BY injured_salary DESC, injury_span_sk LIMIT 25",
)
def leaderboard_spans_by_function(spark, sf_dir):
    return _doubles(R.leaderboard(_report(spark, sf_dir), "injured_salary", 25, careers=False).select("injury_span_sk", "l_linenumber", "games_missed", "injured_salary"))


@register("leaderboard_careers_by_function", f"WITH {_REPORT} SELECT person_id, name, {_SUMS} FROM rep GROUP BY 1, 2 ORDER BY injured_salary DESC, name, person_id LIMIT 25")
def leaderboard_careers_by_function(spark, sf_dir):
    return _doubles(R.leaderboard(_report(spark, sf_dir), "injured_salary", 25, careers=True))


@register(
    "faceted_bars",
    f"""
    WITH {_REPORT}, g AS (SELECT team, season, CAST(count(*) AS BIGINT) AS injury_count FROM rep WHERE season IN (1996, 1997) AND body_part = 'A' GROUP BY 1, 2)
    SELECT g.*, CAST(place AS INTEGER) AS place FROM g JOIN (SELECT team, row_number() OVER (ORDER BY sum(injury_count) DESC, team) AS place FROM g GROUP BY 1) USING (team)
    """,
)
def faceted_bars(spark, sf_dir):
    rows = R.filtered(_report(spark, sf_dir), {"season": ([1996, 1997], list(range(1995, 2002)), False), "body_part": (["A"], ["A", "N", "R"], False), "injury_type": ([], ["O", "F"], False)})
    return R.league_bars(rows, [], "team", "season", "injury_count")


@register(
    "display_formats",
    r"""
    SELECT o_orderkey, '$' || format('{:,.2f}', o_totalprice) || 'M' AS dollars, format('{:.1f}', CAST(o_orderkey AS DOUBLE) / 3) AS one_decimal FROM orders
    """,
)
def display_formats(spark, sf_dir):
    from spanweave.functions.scalars import dollars, one_decimal

    return table(spark, sf_dir, "orders").select("o_orderkey", dollars(F.col("o_totalprice")).alias("dollars"), one_decimal(F.col("o_orderkey") / 3).alias("one_decimal"))


@register("option_search", "SELECT DISTINCT trim(p_name) AS value FROM part WHERE lower(p_name) LIKE '%a%' AND trim(p_name) <> '' ORDER BY 1 LIMIT 120")
def option_search(spark, sf_dir):
    return facets.search_options(R.options(table(spark, sf_dir, "part"), "p_name"), "value", " A ")
