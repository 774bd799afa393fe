"""Grouped, stacked, pivoted and ranked reports on the shared tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanweave.functions.scalars import truth
from spanweave.operators.aggregates import distinct_text, first_known, null_if_any_null, order_categories, ordered_json, pivot_metrics, share_of_range, stacked, top_n, top_with_others, with_totals
from spanweave.operators.facets import facet, search, yes_no
from spanweave.plans import reports
from spanweave.plans.catalog import register, table

MONEY = "decimal(18,2)"


def _order_values(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", F.col("o_totalprice").cast(MONEY).alias("price"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nation = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))  # 25 rows
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))


@register(
    "stacked_dim_metric",
    """
    SELECT n_name AS nation, CAST(year(o_orderdate) AS INTEGER) AS order_year, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total_price
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2
    """,
)
def stacked_dim_metric(spark, sf_dir):
    rows = _order_values(spark, sf_dir).select(F.col("n_name").alias("nation"), F.year("o_orderdate").alias("order_year"), "price")
    return stacked(rows, ["nation", "order_year"], F.col("price"), "total_price").withColumn("total_price", F.col("total_price").cast("decimal(28,2)"))


@register(
    "ordered_stack",
    """
    WITH g AS (SELECT n_name AS nation, c_mktsegment AS segment, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2),
    p AS (SELECT nation, CAST(row_number() OVER (ORDER BY sum(total) DESC, nation) AS INTEGER) AS place FROM g GROUP BY 1)
    SELECT nation, segment, total, place FROM g JOIN p USING (nation)
    """,
)
def ordered_stack(spark, sf_dir):
    rows = _order_values(spark, sf_dir).select(F.col("n_name").alias("nation"), F.col("c_mktsegment").alias("segment"), "price")
    grouped = stacked(rows, ["nation", "segment"], F.col("price"), "total").withColumn("total", F.col("total").cast("decimal(28,2)"))
    return order_categories(grouped, "nation", "total")


@register(
    "null_keys_left_out",
    """
    SELECT kind, CAST(count(*) AS BIGINT) AS n FROM (SELECT CASE WHEN event_type <> 'view' THEN event_type END AS kind FROM events) WHERE kind IS NOT NULL GROUP BY 1
    """,
)
def null_keys_left_out(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.when(F.col("event_type") != "view", F.col("event_type")).alias("kind"))
    return stacked(rows, ["kind", "kind"], F.lit(1), "n")


@register(
    "top_n_with_others",
    """
    WITH t AS (SELECT c_name AS name, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1),
    r AS (SELECT *, row_number() OVER (ORDER BY total DESC, name) AS n FROM t)
    SELECT CASE WHEN n <= 30 THEN name ELSE 'Others' END AS name, CAST(sum(total) AS DECIMAL(28,2)) AS total FROM r GROUP BY 1
    """,
)
def top_n_with_others(spark, sf_dir):
    rows = _order_values(spark, sf_dir).select(F.col("c_name").alias("name"), F.col("price").alias("total"))
    return top_with_others(rows, "name", "total", 30).withColumn("total", F.col("total").cast("decimal(28,2)"))


@register(
    "leaderboard_career",
    """
    SELECT c_custkey, c_name, CAST(count(*) AS BIGINT) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2 ORDER BY total DESC, c_custkey LIMIT 20
    """,
)
def leaderboard_career(spark, sf_dir):
    sums = _order_values(spark, sf_dir).groupBy("c_custkey", "c_name").agg(F.count("*").alias("n_orders"), F.sum("price").cast("decimal(28,2)").alias("total"))
    return top_n(sums, [F.col("total").desc(), F.col("c_custkey")], 20)


@register(
    "leaderboard_single",
    "SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders ORDER BY price DESC, o_orderkey LIMIT 20",
)
def leaderboard_single(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").cast(MONEY).alias("price"))
    return top_n(rows, [F.col("price").desc(), F.col("o_orderkey")], 20)


@register(
    "summary_with_total",
    """
    WITH g AS (SELECT l_returnflag AS dim, CAST(l_quantity AS DECIMAL(18,2)) AS q, CAST(l_extendedprice AS DECIMAL(18,2)) AS p FROM lineitem)
    SELECT dim, CAST(count(*) AS BIGINT) AS n, CAST(sum(q) AS DECIMAL(28,2)) AS quantity, CAST(sum(p) AS DECIMAL(28,2)) AS price FROM g GROUP BY 1
    UNION ALL SELECT 'Total', CAST(count(*) AS BIGINT), CAST(sum(q) AS DECIMAL(28,2)), CAST(sum(p) AS DECIMAL(28,2)) FROM g
    """,
)
def summary_with_total(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("dim"), F.col("l_quantity").cast(MONEY).alias("q"), F.col("l_extendedprice").cast(MONEY).alias("p"))
    sums = [F.count("*").alias("n"), F.sum("q").cast("decimal(28,2)").alias("quantity"), F.sum("p").cast("decimal(28,2)").alias("price")]
    return with_totals(rows, ["dim"], sums)


@register(
    "totals_of_two_dims",
    """
    WITH g AS (SELECT l_returnflag AS flag, CASE WHEN l_linenumber > 2 THEN l_linenumber END AS line, CAST(l_quantity AS DECIMAL(18,2)) AS q FROM lineitem)
    SELECT CASE WHEN grouping(flag) = 1 THEN 'All' ELSE flag END AS flag, CASE WHEN grouping(line) = 1 THEN 'All' ELSE CAST(line AS VARCHAR) END AS line, CAST(count(*) AS BIGINT) AS n, CAST(sum(q) AS DECIMAL(28,2)) AS quantity FROM g GROUP BY CUBE (flag, line)
    """,
)
def totals_of_two_dims(spark, sf_dir):
    """Both dims, each alone, and all, from one scan; a line number that is null is no total."""
    line = F.when(F.col("l_linenumber") > 2, F.col("l_linenumber"))
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("flag"), line.alias("line"), F.col("l_quantity").cast(MONEY).alias("q"))
    return with_totals(rows, ["flag", "line"], [F.count("*").alias("n"), F.sum("q").cast("decimal(28,2)").alias("quantity")], "All", every=True)


@register(
    "group_stats_pop",
    """
    SELECT l_suppkey, CAST(count(DISTINCT l_orderkey) AS BIGINT) AS n_orders, round(avg(l_quantity), 4) AS avg_quantity, round(stddev_pop(l_quantity), 4) AS std_quantity
    FROM lineitem GROUP BY 1
    """,
)
def group_stats_pop(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.countDistinct("l_orderkey").alias("n_orders"), F.round(F.avg("l_quantity"), 4).alias("avg_quantity"), F.round(F.stddev_pop("l_quantity"), 4).alias("std_quantity")
    )


_PIVOT = ", ".join(f"max(l_{m}) FILTER (l_returnflag = '{k}') AS {k.lower()}_l_{m}" for k in "ANR" for m in ("quantity", "extendedprice", "discount"))


@register("pivot_type_metrics", f"SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS ship_year, {_PIVOT} FROM lineitem GROUP BY 1, 2")
def pivot_type_metrics(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("ship_year", F.year("l_shipdate"))
    return pivot_metrics(rows, ["l_suppkey", "ship_year"], "l_returnflag", ["A", "N", "R"], ["l_quantity", "l_extendedprice", "l_discount"])


_KINDS = [f"{k}_l_{m}" for k in "anr" for m in ("quantity", "discount")]


@register(
    "pivot_lag_delta",
    f"""
    WITH p AS (SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS ship_year,
        {", ".join(f"max(l_{m}) FILTER (l_returnflag = '{k}') AS {k.lower()}_l_{m}" for k in "ANR" for m in ("quantity", "discount"))} FROM lineitem GROUP BY 1, 2)
    SELECT *, {", ".join(f"{c} - lag({c}) OVER w AS {c}_delta" for c in _KINDS)} FROM p WINDOW w AS (PARTITION BY l_suppkey ORDER BY ship_year)
    """,
)
def pivot_lag_delta(spark, sf_dir):
    from spanweave.plans.outings import kind_metrics

    rows = table(spark, sf_dir, "lineitem").withColumn("ship_year", F.year("l_shipdate"))
    return kind_metrics(rows, ["l_suppkey", "ship_year"], "l_returnflag", ["A", "N", "R"], ["l_quantity", "l_discount"], "l_suppkey", "ship_year")


@register(
    "distinct_text_list",
    "SELECT o_custkey, string_agg(DISTINCT o_orderpriority, '; ' ORDER BY o_orderpriority) AS priorities FROM orders GROUP BY 1",
)
def distinct_text_list(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(distinct_text("o_orderpriority").alias("priorities"))


@register(
    "any_null_open_end",
    """
    SELECT l_orderkey, CASE WHEN sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) > 0 THEN NULL ELSE max(CAST(l_shipdate AS DATE)) END AS last_ship FROM lineitem GROUP BY 1
    """,
)
def any_null_open_end(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", F.when(F.col("l_linestatus") != "O", F.to_date("l_shipdate")).alias("shipped"))
    return rows.groupBy("l_orderkey").agg(null_if_any_null("shipped").alias("last_ship"))


@register(
    "first_known_value",
    "SELECT user_id, arg_min(event_type, (ts, event_id)) FILTER (event_type <> 'view') AS first_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1",
)
def first_known_value(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("kind", F.when(F.col("event_type") != "view", F.col("event_type")))
    return rows.groupBy("user_id").agg(first_known("kind", F.struct("ts", "event_id")).alias("first_type"), F.count("*").alias("n"))


@register(
    "ordered_json_fields",
    """
    SELECT l_orderkey, CAST(count(*) FILTER (l_quantity > 10) AS INTEGER) AS n_items,
           arg_min(l_partkey, (l_linenumber, l_partkey)) FILTER (l_quantity > 10) AS first_part FROM lineitem GROUP BY 1
    """,
)
def ordered_json_fields(spark, sf_dir):
    text = ordered_json([F.col("l_partkey").alias("part"), F.col("l_quantity").alias("quantity")], F.struct("l_linenumber", "l_partkey"), F.col("l_quantity") > 10)
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(text.alias("items"))
    parsed = F.from_json("items", "array<struct<part:bigint,quantity:double>>")
    return rows.select("l_orderkey", F.size(parsed).alias("n_items"), F.try_element_at(parsed, F.lit(1))["part"].alias("first_part"))


@register(
    "presence_flags",
    """
    SELECT user_id, bool_or(event_type = 'error') AS any_error, CAST(coalesce(sum(CASE WHEN event_type = 'purchase' THEN 1 END), 0) AS BIGINT) AS n_purchases,
           round(regr_slope(value, event_id), 8) AS slope FROM events GROUP BY 1 HAVING count(*) > 1
    """,
)
def presence_flags(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.bool_or(F.col("event_type") == "error").alias("any_error"), F.coalesce(F.sum(F.when(F.col("event_type") == "purchase", 1)), F.lit(0)).alias("n_purchases"),
        F.round(F.regr_slope("value", "event_id"), 8).alias("slope"), F.count("*").alias("n"),
    ).where("n > 1").drop("n")


@register(
    "latest_season_rows",
    "SELECT o_orderkey, o_custkey FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)",
)
def latest_season_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("y", F.year("o_orderdate"))
    latest = orders.agg(F.max("y").alias("y"))
    return orders.join(F.broadcast(latest), "y").select("o_orderkey", "o_custkey")  # one row


@register(
    "min_max_share",
    "SELECT p_partkey, round((p_retailprice - min(p_retailprice) OVER ()) / nullif(max(p_retailprice) OVER () - min(p_retailprice) OVER (), 0), 8) AS share FROM part",
)
def min_max_share(spark, sf_dir):
    rows = share_of_range(table(spark, sf_dir, "part").select("p_partkey", "p_retailprice"), "p_retailprice", "share")
    return rows.select("p_partkey", F.round("share", 8).alias("share"))


@register(
    "facet_filter_two_column",
    """
    SELECT p_partkey FROM part WHERE (p_brand IN ('Brand#11', 'Brand#12', 'Brand#23') OR p_type IN ('Brand#11', 'Brand#12', 'Brand#23')) AND p_size >= 5 AND lower(p_name) LIKE '%e%'
    """,
)
def facet_filter_two_column(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    chosen = ["Brand#11", "Brand#12", "Brand#23"]
    some = facet(["p_brand", "p_type"], chosen, [*chosen, "Brand#31"])
    everything = facet("p_type", ["x"], ["x"])
    return part.where(some & everything & yes_no("p_size", "any") & (F.col("p_size") >= 5) & search("p_name", " E ")).select("p_partkey")


@register("yes_no_facet", "SELECT o_orderkey FROM orders WHERE (o_orderstatus = 'F') = true")
def yes_no_facet(spark, sf_dir):
    return table(spark, sf_dir, "orders").withColumn("done", truth(F.when(F.col("o_orderstatus") == "F", "Yes"))).where(yes_no("done", "yes")).select("o_orderkey")


@register(
    "option_list",
    "SELECT DISTINCT trim(v) AS value FROM (SELECT c_mktsegment AS v FROM customer UNION ALL SELECT n_name FROM nation UNION ALL SELECT r_name FROM region) WHERE trim(v) <> ''",
)
def option_list(spark, sf_dir):
    names = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("v"))
    names = names.unionByName(table(spark, sf_dir, "nation").select(F.col("n_name").alias("v"))).unionByName(table(spark, sf_dir, "region").select(F.col("r_name").alias("v")))
    return reports.options(names, "v")


@register("parameter_filter", "SELECT * FROM nation WHERE n_regionkey = 2")
def parameter_filter(spark, sf_dir):
    return reports.where_equal(table(spark, sf_dir, "nation"), n_regionkey=2)


@register(
    "union_all_home_away",
    """
    SELECT nation, CAST(sum(n) AS BIGINT) AS n FROM (SELECT c_nationkey AS nation, 1 AS n FROM customer UNION ALL SELECT s_nationkey, 1 FROM supplier) GROUP BY 1
    """,
)
def union_all_home_away(spark, sf_dir):
    both = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation")).unionByName(table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation")))
    return both.groupBy("nation").agg(F.count("*").alias("n"))


@register("union_distinct", "SELECT l_partkey AS k, l_orderkey AS o FROM lineitem UNION SELECT l_suppkey, l_orderkey FROM lineitem")
def union_distinct(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    return lines.select(F.explode(F.array("l_partkey", "l_suppkey")).alias("k"), F.col("l_orderkey").alias("o")).distinct()


@register(
    "career_range",
    """
    SELECT o_custkey AS person_id, CAST(min(year(o_orderdate)) AS INTEGER) AS first_year,
           CAST(coalesce(max(CASE WHEN o_orderstatus = 'F' THEN year(o_orderdate) END), 2000) AS INTEGER) AS last_year FROM orders GROUP BY 1
    """,
)
def career_range(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("person_id"), F.year("o_orderdate").alias("debut_year"), F.when(F.col("o_orderstatus") == "F", F.year("o_orderdate")).alias("last_year")
    )
    return reports.career(rows, F.lit(2000))
