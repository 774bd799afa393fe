"""Expressions, text, upserts and schemas on the shared tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanweave.functions import scalars as S
from spanweave.functions.extraction import first_by_priority, mentions
from spanweave.operators.schemas import flatten
from spanweave.operators.tables import apply_overrides, upsert_coalesce, upsert_replace
from spanweave.plans.catalog import register, table
from spanweave.sources.landed import csv_export_url, links, table_rows


@register(
    "case_code_map",
    """
    SELECT p_partkey, CASE WHEN p_size IN (1, 2, 3, 4, 5) THEN 'small' WHEN p_size IS NULL THEN NULL WHEN p_size <= 20 THEN 'middle' ELSE 'large' END AS size_class,
           CASE WHEN p_retailprice > 1500 THEN 1500 ELSE p_retailprice END AS capped FROM part
    """,
)
def case_code_map(spark, sf_dir):
    size = F.col("p_size")
    label = F.when(size.isin(1, 2, 3, 4, 5), "small").when(size.isNull(), None).when(size <= 20, "middle").otherwise("large")
    return table(spark, sf_dir, "part").select("p_partkey", label.alias("size_class"), S.clamp_above(F.col("p_retailprice"), 1500.0).alias("capped"))


@register(
    "ladder_scale",
    """
    SELECT l_orderkey, l_linenumber, CASE WHEN l_discount >= 0.08 THEN 3.0 WHEN l_discount >= 0.04 THEN 2.0 WHEN l_discount >= 0.01 THEN 1.0 ELSE l_tax END AS step,
           round(33 * l_discount + 65 * (1 - l_discount), 6) AS blend FROM lineitem
    """,
)
def ladder_scale(spark, sf_dir):
    share = F.col("l_discount")
    step = S.scaled_share(share, [(0.08, 3.0), (0.04, 2.0), (0.01, 1.0)], F.col("l_tax"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", step.alias("step"), F.round(33 * share + 65 * (1 - share), 6).alias("blend"))


@register(
    "surrogate_key_md5",
    f"SELECT l_orderkey, l_linenumber, md5(concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), coalesce(nullif(l_returnflag, 'N'), '{S.NULL_KEY}'))) AS sk FROM lineitem",
)
def surrogate_key_md5(spark, sf_dir):
    flag = F.nullif(F.col("l_returnflag"), F.lit("N"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", S.surrogate_key("l_orderkey", "l_linenumber", flag).alias("sk"))


@register(
    "split_part_parse",
    """
    SELECT p_partkey, CAST(split_part(h, '''', 1) AS INTEGER) * 12 + CAST(trim(split_part(split_part(h, '''', 2), '"', 1)) AS INTEGER) AS inches
    FROM (SELECT p_partkey, concat(5 + p_size % 2, ''' ', p_size % 12, '"') AS h FROM part)
    """,
)
def split_part_parse(spark, sf_dir):
    height = F.concat((5 + F.col("p_size") % 2).cast("string"), F.lit("' "), (F.col("p_size") % 12).cast("string"), F.lit('"'))
    return table(spark, sf_dir, "part").select("p_partkey", S.height_inches(height).alias("inches"))


@register(
    "money_parse",
    """
    SELECT c_custkey, CAST(CASE WHEN c_acctbal < 0 THEN -floor(abs(c_acctbal)) ELSE floor(c_acctbal) END AS BIGINT) AS amount FROM customer
    """,
)
def money_parse(spark, sf_dir):
    whole = F.format_number(F.floor(F.abs("c_acctbal")), 0)
    shown = F.when(F.col("c_acctbal") < 0, F.concat(F.lit("($"), whole, F.lit(")"))).otherwise(F.concat(F.lit("$"), whole))
    return table(spark, sf_dir, "customer").select("c_custkey", S.money(shown).alias("amount"))


@register(
    "name_normalize",
    r"""
    SELECT c_custkey, lower(split_part(c_name, '#', 2)) || ' ' || lower(split_part(c_name, '#', 1)) AS name FROM customer
    """,
)
def name_normalize(spark, sf_dir):
    swapped = S.given_name_first(F.regexp_replace(F.col("c_name"), "#", ", "))
    return table(spark, sf_dir, "customer").select("c_custkey", S.plain_name(swapped).alias("name"))


@register(
    "regex_scrub",
    r"""
    SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(' ' || regexp_replace(t, '[^a-z0-9]+', '  ', 'g') || ' ', ' (?:the|of|and|was) ', ' ', 'g'), '[0-9]+', '', 'g'), ' +', ' ', 'g')) AS scrubbed
    FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
    """,
)
def regex_scrub(spark, sf_dir):
    text = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = S.without_words(F.regexp_replace(text, "[^a-z0-9]+", " "), ["the", "of", "and", "was"])
    return table(spark, sf_dir, "documents").select("doc_id", S.squeeze(F.regexp_replace(out, "[0-9]+", "")).alias("scrubbed"))


_TERMS = ["idiot", "moron", "trash", "licensed under the apache license", "licensed", "apache", "license"]
_RANKS = ("licensed under the apache license", "moron", "idiot", "trash", "license")


@register(
    "dictionary_extract",
    rf"""
    WITH t AS (SELECT doc_id, regexp_extract_all(regexp_replace(lower(text), '([^a-z0-9]+)', ' \1 ', 'g'), '(?:^|[^a-z0-9])({"|".join(sorted((x.replace(" ", " +") for x in _TERMS), key=len, reverse=True))})(?:$|[^a-z0-9])', 1) AS raw FROM documents),
    f AS (SELECT doc_id, list_transform(raw, lambda x: regexp_replace(x, ' +', ' ', 'g')) AS found FROM t)
    SELECT doc_id, CAST(len(found) AS INTEGER) AS n_found,
           CASE {" ".join(f"WHEN list_contains(found, '{t}') THEN '{t}'" for t in _RANKS)} END AS first_found FROM f
    """,
)
def dictionary_extract(spark, sf_dir):
    found = mentions(F.lower("text"), _TERMS)
    return table(spark, sf_dir, "documents").select("doc_id", F.size(found).alias("n_found"), first_by_priority(found, _RANKS).alias("first_found"))


@register(
    "integer_division_ratio",
    "SELECT l_orderkey, l_linenumber, CAST((l_partkey // (l_linenumber * l_linenumber)) * 703 AS BIGINT) AS whole, round(l_partkey / (l_linenumber * l_linenumber) * 703, 4) AS exact FROM lineitem",
)
def integer_division_ratio(spark, sf_dir):
    weight, inches = F.col("l_partkey"), F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", S.body_mass_index(weight, inches, whole=True).cast("long").alias("whole"), F.round(S.body_mass_index(weight, inches), 4).alias("exact"))


@register(
    "salary_floor_value",
    """
    SELECT o_custkey, y, CAST(CASE WHEN total < 300000 THEN 300000 ELSE total END AS DECIMAL(28,2)) AS pay,
           CAST(round(CAST(CASE WHEN total < 300000 THEN 300000 ELSE total END AS DECIMAL(28,2)) * n / 162 / 1000000, 2) AS DOUBLE) AS injured_pay
    FROM (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS y, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY ALL)
    """,
)
def salary_floor_value(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"), F.count("*").alias("n"))
    pay = F.greatest(F.coalesce("total", F.lit(0)), F.lit(300000)).cast("decimal(28,2)")
    return rows.select("o_custkey", "y", pay.alias("pay"), F.round(pay.cast("double") * F.col("n") / 162 / 1_000_000, 2).alias("injured_pay"))


@register(
    "open_interval_currency",
    """
    SELECT o_orderkey, o_orderstatus = 'O' AS is_open, CAST(CASE WHEN o_orderstatus = 'O' THEN DATE '2000-01-01' ELSE CAST(o_orderdate AS DATE) + 30 END - CAST(o_orderdate AS DATE) AS INTEGER) AS length FROM orders
    """,
)
def open_interval_currency(spark, sf_dir):
    day = F.to_date("o_orderdate")
    end = F.when(F.col("o_orderstatus") != "O", F.date_add(day, 30))
    return table(spark, sf_dir, "orders").select("o_orderkey", end.isNull().alias("is_open"), F.datediff(S.open_end(end, F.lit("2000-01-01").cast("date")), day).alias("length"))


def _customers(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    old = rows.where("c_custkey % 3 <> 0")
    batch = rows.where("c_custkey % 2 = 0").select("c_custkey", F.lit(None).cast("string").alias("c_name"), F.lower("c_mktsegment").alias("c_mktsegment"), "c_nationkey")
    return old, batch.unionByName(batch.limit(0)).unionByName(spark.createDataFrame([(None, "lost", "lost", 1)], batch.schema))


_CUSTOMERS = """old AS (SELECT c_custkey, c_name, c_mktsegment, c_nationkey FROM customer WHERE c_custkey % 3 <> 0),
    batch AS (SELECT c_custkey, CAST(NULL AS VARCHAR) AS c_name, lower(c_mktsegment) AS c_mktsegment, c_nationkey FROM customer WHERE c_custkey % 2 = 0)"""


@register(
    "upsert_coalesce",
    f"""
    WITH {_CUSTOMERS}
    SELECT coalesce(b.c_custkey, o.c_custkey) AS c_custkey, coalesce(b.c_name, o.c_name) AS c_name, coalesce(b.c_mktsegment, o.c_mktsegment) AS c_mktsegment, coalesce(b.c_nationkey, o.c_nationkey) AS c_nationkey
    FROM old o FULL JOIN batch b ON o.c_custkey = b.c_custkey
    """,
)
def upsert_coalesced(spark, sf_dir):
    return upsert_coalesce(*_customers(spark, sf_dir), ["c_custkey"])


@register("upsert_replace", f"WITH {_CUSTOMERS} SELECT * FROM old WHERE c_custkey NOT IN (SELECT c_custkey FROM batch) UNION ALL SELECT * FROM batch")
def upsert_replaced(spark, sf_dir):
    return upsert_replace(*_customers(spark, sf_dir), ["c_custkey"])


@register(
    "overrides_apply",
    """
    SELECT n_nationkey, CASE WHEN n_nationkey = 3 THEN 'CHANGED' ELSE n_name END AS n_name, n_regionkey FROM nation WHERE n_nationkey NOT IN (5, 7, 9)
    UNION ALL SELECT 7, 'NEW', 0 UNION ALL SELECT 99, 'ADDED', 1
    """,
)
def overrides_apply(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    updates = spark.createDataFrame([(3, "CHANGED"), (1000, "NOBODY")], "n_nationkey int, n_name string")
    deletes = spark.createDataFrame([(5,), (9,)], "n_nationkey int")
    upserts = spark.createDataFrame([(7, "NEW", 0), (99, "ADDED", 1)], "n_nationkey int, n_name string, n_regionkey int")
    return apply_overrides(nation, "n_nationkey", updates, deletes, upserts)


@register(
    "resume_point_window",
    "SELECT event_id, ts FROM events WHERE CAST(ts AS DATE) >= (SELECT max(CAST(ts AS DATE)) - 7 FROM events)",
)
def resume_point_window(spark, sf_dir):
    from spanweave.operators.tables import resume_point

    events = table(spark, sf_dir, "events")
    return events.where(F.to_date("ts") >= resume_point(events, "ts", 7)).select("event_id", "ts")


@register(
    "incremental_window",
    """
    SELECT o_custkey, o_orderkey, CAST(d - lag(d) OVER (PARTITION BY o_custkey ORDER BY d, o_orderkey) AS INTEGER) AS gap FROM (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
    """,
)
def incremental_window(spark, sf_dir):
    """A full build up to a day, then a window merged in with enough margin: equal to a full build of everything."""
    from pyspark.sql import Window

    from spanweave.operators.tables import recompute_window

    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("d"))

    def gaps(rows):
        before = F.lag("d").over(Window.partitionBy("o_custkey").orderBy("d", "o_orderkey"))
        return rows.select("o_custkey", "o_orderkey", "d", F.datediff("d", before).alias("gap"))

    last = orders.agg(F.max("d").alias("m"))
    old = gaps(orders.join(F.broadcast(last)).where(F.col("d") <= F.date_sub("m", 20)).drop("m"))
    return recompute_window(orders, old, "d", ["o_orderkey"], 35, 10_000, gaps).select("o_custkey", "o_orderkey", "gap")


@register(
    "json_flatten",
    "SELECT event_id, CAST(props->>'k' AS BIGINT) AS props_k FROM events",
)
def json_flatten(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint").alias("props"))
    return flatten(rows)


@register(
    "link_extract",
    r"""
    SELECT page_id, CAST(len(a) AS INTEGER) AS n_links, CASE WHEN len(a) > 0 THEN regexp_extract(a[1], '(?is)href\s*=\s*["'']([^"'']*)["'']', 1) END AS first_href
    FROM (SELECT page_id, regexp_extract_all(html, '(?is)(<a\s[^>]*href\s*=\s*["''][^"'']*["''][^>]*>.*?</a>)', 1) AS a FROM pages)
    """,
)
def link_extract(spark, sf_dir):
    found = links(F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", F.size(found).alias("n_links"), F.try_element_at(found, F.lit(1))["href"].alias("first_href"))


@register(
    "table_row_extract",
    r"""
    SELECT page_id, CAST(coalesce(len(regexp_extract_all(coalesce(t[1], ''), '(?is)(<tr\b.*?</tr>)', 1)), 0) AS INTEGER) AS n_rows
    FROM (SELECT page_id, regexp_extract_all(html, '(?is)(<table\b.*?</table>)', 1) AS t FROM pages)
    """,
)
def table_row_extract(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.size(table_rows(F.col("html"), 1)).alias("n_rows"))


@register("url_normalize", "SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url ELSE url || '&x=1?output=csv' END AS url FROM pages")
def url_normalize(spark, sf_dir):
    """Addresses that ask for a page, two of three, ask for its rows."""
    asked = F.when(F.col("page_id") % 3 == 0, F.col("url")).otherwise(F.concat("url", F.lit("&x=1?output=html")))
    return table(spark, sf_dir, "pages").select("page_id", csv_export_url(asked).alias("url"))


@register(
    "date_chunk_list",
    """
    SELECT CAST(d AS DATE) AS chunk_start, least(CAST(d AS DATE) + 4, (SELECT max(CAST(ts AS DATE)) FROM events)) AS chunk_end
    FROM (SELECT unnest(generate_series((SELECT min(CAST(ts AS DATE)) FROM events)::TIMESTAMP, (SELECT max(CAST(ts AS DATE)) FROM events)::TIMESTAMP, INTERVAL 5 DAY)) AS d)
    """,
)
def date_chunk_list(spark, sf_dir):
    from spanweave.sources.landed import date_chunks

    ends = table(spark, sf_dir, "events").agg(F.min(F.to_date("ts")).alias("a"), F.max(F.to_date("ts")).alias("b")).first()
    return date_chunks(spark, str(ends.a), str(ends.b), 5)


@register(
    "missing_partition_dates",
    """
    SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 20)
    """,
)
def missing_partition_dates(spark, sf_dir):
    from spanweave.sources.landed import missing_dates

    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "key")
    return missing_dates(orders, table(spark, sf_dir, "lineitem").where("l_quantity > 20").withColumnRenamed("l_orderkey", "key"), "key", "o_orderdate")
