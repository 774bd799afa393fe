"""Joins on the shared tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanweave.operators.joins import asof_join, clip, count_between, either_key, fill_wanted, first_match, overlap_join
from spanweave.operators.windows import keep_first
from spanweave.plans.catalog import register, table


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events")


def _next_purchase(spark, sf_dir, allow_exact, **more):
    events = _events(spark, sf_dir).withColumn("ts", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    views = events.where("event_type = 'view'").select("event_id", "user_id", "ts")
    bought = events.where("event_type = 'purchase'").select("user_id", F.col("ts").alias("next_ts"), F.col("event_id").alias("next_id"))
    return asof_join(views, bought, ["user_id"], "ts", "next_ts", allow_exact=allow_exact, tie=["next_id"], **more)


def _asof_sql(op):
    return f"""
    WITH e AS (SELECT event_id, user_id, date_trunc('hour', ts) AS ts, event_type FROM events),
    p AS (SELECT user_id, ts AS next_ts, min(event_id) AS next_id FROM e WHERE event_type = 'purchase' GROUP BY ALL)
    SELECT v.event_id, v.user_id, CAST(v.ts AS TIMESTAMP) AS ts, CAST(p.next_ts AS TIMESTAMP) AS next_ts, p.next_id
    FROM (SELECT * FROM e WHERE event_type = 'view') v ASOF LEFT JOIN p ON v.user_id = p.user_id AND v.ts {op} p.next_ts
    """


@register("asof_next_event_strict", _asof_sql("<"))
def asof_next_event_strict(spark, sf_dir):
    return _next_purchase(spark, sf_dir, False)


@register("asof_next_event_inclusive", _asof_sql("<="))
def asof_next_event_inclusive(spark, sf_dir):
    return _next_purchase(spark, sf_dir, True)


@register("asof_next_event_sliced", _asof_sql("<"))
def asof_next_event_sliced(spark, sf_dir):
    return _next_purchase(spark, sf_dir, False, slice_by=F.to_date("_ts"))


@register(
    "asof_last_event_backward",
    """
    WITH p AS (SELECT user_id, ts AS last_ts, min(event_id) AS last_id FROM events WHERE event_type = 'signup' GROUP BY ALL)
    SELECT v.event_id, v.user_id, v.ts, p.last_ts, p.last_id
    FROM (SELECT * FROM events WHERE event_type = 'click') v ASOF LEFT JOIN p ON v.user_id = p.user_id AND v.ts >= p.last_ts
    """,
)
def asof_last_event_backward(spark, sf_dir):
    events = _events(spark, sf_dir)
    clicks = events.where("event_type = 'click'").select("event_id", "user_id", "ts")
    signed = events.where("event_type = 'signup'").select("user_id", F.col("ts").alias("last_ts"), F.col("event_id").alias("last_id"))
    return asof_join(clicks, signed, ["user_id"], "ts", "last_ts", direction="backward", tie=["last_id"])


def _spans(spark, sf_dir):
    """Each order as a span from its date to its last shipment."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max(F.to_date("l_shipdate")).alias("span_end"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("span_start"))
    return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).drop("l_orderkey").where("span_end >= span_start")


_SPANS = """spans AS (
    SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS span_start, s AS span_end
    FROM orders JOIN (SELECT l_orderkey, max(CAST(l_shipdate AS DATE)) AS s FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey
    WHERE s >= CAST(o_orderdate AS DATE))"""
_PERIODS = """periods AS (
    SELECT o_custkey, CAST(o_orderdate AS DATE) AS period_start, CAST(o_orderdate AS DATE) + 400 AS period_end, o_orderkey AS period_key
    FROM orders)"""
_OVERLAP = f"""
    WITH {_SPANS}, {_PERIODS}
    SELECT s.o_orderkey, s.o_custkey, p.period_key, greatest(s.span_start, p.period_start) AS start_date, least(s.span_end, p.period_end) AS end_date
    FROM spans s LEFT JOIN periods p ON s.o_custkey = p.o_custkey AND s.span_start < p.period_end AND s.span_end >= p.period_start
    """


def _overlap(spark, sf_dir, slice_days):
    periods = table(spark, sf_dir, "orders")
    day = F.to_date("o_orderdate")
    periods = periods.select("o_custkey", day.alias("period_start"), F.date_add(day, 400).alias("period_end"), F.col("o_orderkey").alias("period_key"))
    rows = overlap_join(_spans(spark, sf_dir), periods, ["o_custkey"], ("span_start", "span_end"), ("period_start", "period_end"), slice_days=slice_days)
    start, end = clip(F.col("span_start"), F.col("span_end"), F.col("period_start"), F.col("period_end"))
    return rows.select("o_orderkey", "o_custkey", "period_key", start.alias("start_date"), end.alias("end_date"))


@register("interval_overlap_clip", _OVERLAP)
def interval_overlap_clip(spark, sf_dir):
    return _overlap(spark, sf_dir, None)


@register("interval_overlap_sliced", _OVERLAP)
def interval_overlap_sliced(spark, sf_dir):
    return _overlap(spark, sf_dir, 90)


@register(
    "interval_attribution",
    f"""
    WITH {_SPANS}, {_PERIODS},
    hit AS (SELECT s.o_orderkey, s.o_custkey, s.span_start, s.span_end, p.period_key,
            row_number() OVER (PARTITION BY s.o_orderkey ORDER BY p.period_start NULLS LAST, p.period_key NULLS LAST) AS n
        FROM spans s LEFT JOIN periods p ON s.o_custkey = p.o_custkey AND s.span_start < p.period_end AND s.span_end >= p.period_start)
    SELECT o_orderkey, o_custkey, span_start, span_end, period_key FROM hit WHERE n = 1
    """,
)
def interval_attribution(spark, sf_dir):
    periods = table(spark, sf_dir, "orders")
    day = F.to_date("o_orderdate")
    periods = periods.select("o_custkey", day.alias("period_start"), F.date_add(day, 400).alias("period_end"), F.col("o_orderkey").alias("period_key"))
    rows = overlap_join(_spans(spark, sf_dir), periods, ["o_custkey"], ("span_start", "span_end"), ("period_start", "period_end"))
    one = keep_first(rows, ["o_orderkey"], [F.col("period_start").asc_nulls_last(), F.col("period_key").asc_nulls_last()])
    return one.select("o_orderkey", "o_custkey", "span_start", "span_end", "period_key")


@register(
    "year_slice_spans",
    f"""
    WITH {_SPANS}
    SELECT o_orderkey, CAST(y AS INTEGER) AS season, greatest(span_start, make_date(y, 1, 1)) AS start_date, least(span_end, make_date(y, 12, 31)) AS end_date
    FROM (SELECT *, unnest(generate_series(year(span_start), year(span_end))) AS y FROM spans)
    """,
)
def year_slice_spans(spark, sf_dir):
    from spanweave.plans.spans import by_year

    rows = by_year(_spans(spark, sf_dir), "span_start", "span_end")
    return rows.select("o_orderkey", "season", F.col("span_start").alias("start_date"), F.col("span_end").alias("end_date"))


_COUNTED = f"""
    WITH {_SPANS}
    SELECT s.o_orderkey, CAST(count(DISTINCT p.o_orderkey) AS BIGINT) AS n_orders
    FROM spans s JOIN orders p ON s.o_custkey = p.o_custkey AND CAST(p.o_orderdate AS DATE) > s.span_start AND CAST(p.o_orderdate AS DATE) <= s.span_end
    GROUP BY 1
    """


def _orders_within(spark, sf_dir, slice_days):
    points = table(spark, sf_dir, "orders").select("o_custkey", F.to_date("o_orderdate").alias("at"), F.col("o_orderkey").alias("point_key"))
    rows = count_between(_spans(spark, sf_dir), points, ["o_custkey"], "span_start", "span_end", "at", "point_key", "n_orders", slice_days)
    return rows.select("o_orderkey", "n_orders")


@register("range_count_between", _COUNTED)
def range_count_between(spark, sf_dir):
    return _orders_within(spark, sf_dir, None)


@register("range_count_sliced", _COUNTED)
def range_count_sliced(spark, sf_dir):
    return _orders_within(spark, sf_dir, 60)


@register(
    "range_count_repeated",
    f"""
    WITH {_SPANS}
    SELECT s.o_orderkey, CAST(count(DISTINCT l.l_suppkey) AS BIGINT) AS n_suppliers
    FROM spans s JOIN orders o ON s.o_custkey = o.o_custkey JOIN lineitem l ON l.l_orderkey = o.o_orderkey
        AND CAST(l.l_shipdate AS DATE) > s.span_start AND CAST(l.l_shipdate AS DATE) <= s.span_end
    GROUP BY 1
    """,
)
def range_count_repeated(spark, sf_dir):
    """Suppliers of a customer's shipments in each span: many of them ship several times."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    points = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", F.to_date("l_shipdate").alias("at")).join(orders, "l_orderkey").drop("l_orderkey")
    rows = count_between(_spans(spark, sf_dir), points, ["o_custkey"], "span_start", "span_end", "at", "l_suppkey", "n_suppliers")
    return rows.select("o_orderkey", "n_suppliers")


@register(
    "either_key_count",
    """
    SELECT n_nationkey, CAST(count(*) AS BIGINT) AS n_lines
    FROM nation JOIN (
        SELECT c_nationkey, s_nationkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN supplier ON l_suppkey = s_suppkey) ON n_nationkey = c_nationkey OR n_nationkey = s_nationkey
    GROUP BY 1
    """,
)
def either_key_count(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(customer, F.col("o_custkey") == F.col("c_custkey")).join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return either_key(rows, ["c_nationkey", "s_nationkey"], "n_nationkey").groupBy("n_nationkey").agg(F.count("*").alias("n_lines"))


@register(
    "double_alias_dim",
    """
    SELECT l_orderkey, l_linenumber, cn.n_name AS customer_nation, sn.n_name AS supplier_nation
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN supplier ON l_suppkey = s_suppkey
    LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey
    """,
)
def double_alias_dim(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    cn = F.broadcast(nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("customer_nation")))  # 25 rows
    sn = F.broadcast(nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("supplier_nation")))
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey").join(cn, "c_nationkey", "left")
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey").join(sn, "s_nationkey", "left")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    rows = lines.join(orders, "l_orderkey").join(customer, "o_custkey", "left").join(supplier, "l_suppkey", "left")
    return rows.select("l_orderkey", "l_linenumber", "customer_nation", "supplier_nation")


@register("semi_exists", "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def semi_exists(spark, sf_dir):
    done = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    return table(spark, sf_dir, "customer").join(done, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")


@register("anti_missing", "SELECT DISTINCT p_brand, p_type FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 45) ")
def anti_missing(spark, sf_dir):
    large = table(spark, sf_dir, "lineitem").where("l_quantity > 45").select("l_partkey")
    return table(spark, sf_dir, "part").join(large, F.col("p_partkey") == F.col("l_partkey"), "left_anti").select("p_brand", "p_type").distinct()


@register(
    "case_insensitive_join",
    "SELECT c_custkey, s_suppkey FROM customer JOIN supplier ON lower(right(c_name, 6)) = lower(right(s_name, 6))",
)
def case_insensitive_join(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", F.lower(F.right("c_name", F.lit(6))).alias("k"))
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", F.lower(F.right("s_name", F.lit(6))).alias("k"))
    return customer.join(supplier, "k").drop("k")


@register(
    "name_variant_match",
    """
    WITH l AS (SELECT c_custkey, unnest([{'i': 0, 'k': c_name}, {'i': 1, 'k': right(c_name, 5)}, {'i': 2, 'k': right(c_name, 3)}], recursive := true) FROM customer),
    r AS (SELECT s_suppkey, unnest([{'j': 0, 'q': s_name}, {'j': 1, 'q': right(s_name, 5)}, {'j': 2, 'q': right(s_name, 3)}], recursive := true) FROM supplier),
    best AS (SELECT c_custkey, s_suppkey, row_number() OVER (PARTITION BY c_custkey ORDER BY i, j, s_suppkey) AS n FROM l JOIN r ON k = q)
    SELECT c.c_custkey, s_suppkey FROM customer c LEFT JOIN best b ON c.c_custkey = b.c_custkey AND n = 1
    """,
)
def name_variant_match(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")

    def variants(c):
        return [F.col(c), F.right(c, F.lit(5)), F.right(c, F.lit(3))]

    return first_match(customer, supplier, variants("c_name"), variants("s_name"), ["c_custkey"], ["s_suppkey"]).select("c_custkey", "s_suppkey")


@register(
    "wanted_zero_fill",
    """
    SELECT k AS event_type, CAST(coalesce(n, 0) AS BIGINT) AS n_events
    FROM (VALUES ('signup'), ('purchase'), ('refund'), ('view')) w(k) LEFT JOIN (SELECT event_type, count(*) AS n FROM events GROUP BY 1) ON k = event_type
    """,
)
def wanted_zero_fill(spark, sf_dir):
    counts = _events(spark, sf_dir).groupBy("event_type").agg(F.count("*").alias("n_events"))
    return fill_wanted(counts, "event_type", ["signup", "purchase", "refund", "view"], ["n_events"])


@register(
    "shifted_season_join",
    """
    WITH y AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total FROM orders GROUP BY ALL)
    SELECT a.o_custkey, a.y AS order_year, a.total, b.total AS next_total FROM y a LEFT JOIN y b ON a.o_custkey = b.o_custkey AND a.y + 1 = b.y
    """,
)
def shifted_season_join(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    years = orders.groupBy("o_custkey", F.year("o_orderdate").alias("order_year")).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(28,2)").alias("total"))
    following = years.select("o_custkey", (F.col("order_year") - 1).alias("order_year"), F.col("total").alias("next_total"))
    return years.join(following, ["o_custkey", "order_year"], "left")
