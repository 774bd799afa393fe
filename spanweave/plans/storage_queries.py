"""Tables that are written and read again: merges by partition, rebuilds of what changed, backfills, a run of models."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from spanweave.operators import partitions, tables
from spanweave.operators.checks import Expectations
from spanweave.plans import span_queries as S
from spanweave.plans import spans as P
from spanweave.plans.catalog import register, table
from spanweave.plans.models import Model, Warehouse
from spanweave.sources.landed import changed_entities, missing_dates, read_seed


def _orders(spark, sf_dir):
    rows = table(spark, sf_dir, "orders")
    return rows.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("d"), F.col("o_totalprice").alias("price"), F.year("o_orderdate").alias("y"))


@register(
    "merge_by_partition",
    """
    WITH o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS d, o_totalprice AS price, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders),
    b AS (SELECT o_orderkey, o_custkey, d, price + 1 AS price, y FROM o WHERE y >= 1997 AND o_orderkey % 3 = 0 UNION ALL SELECT o_orderkey + 1000000000, NULL, d, price, y FROM o WHERE y >= 1997 AND o_orderkey % 7 = 0)
    SELECT * FROM o WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b) UNION ALL SELECT * FROM b
    """,
)
def merge_by_partition(spark, sf_dir):
    """Rows of the last years are changed and added; the partitions of other years aren't touched."""
    rows, path = _orders(spark, sf_dir), tables.new_folder(spark, "orders")
    partitions.merge_partitions(rows, path, ["o_orderkey"], ["y"])
    late = rows.where("y >= 1997")
    added = late.where("o_orderkey % 7 = 0").withColumns({"o_orderkey": F.col("o_orderkey") + 1_000_000_000, "o_custkey": F.lit(None).cast("long")})
    partitions.merge_partitions(late.where("o_orderkey % 3 = 0").withColumn("price", F.col("price") + 1).unionByName(added), path, ["o_orderkey"], ["y"], expects=Expectations(not_null=["d"], unique=["o_orderkey"]))
    return partitions.read_partitions(spark, path)


@register(
    "merge_moves_rows",
    """
    WITH o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS d, o_totalprice AS price, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders)
    SELECT o_orderkey, o_custkey, CASE WHEN moved THEN d + 366 ELSE d END AS d, price, CASE WHEN moved THEN CAST(year(d + 366) AS INTEGER) ELSE y END AS y FROM (SELECT *, y = 1995 OR (y = 1997 AND o_orderkey % 2 = 0) AS moved FROM o)
    """,
)
def merge_moves_rows(spark, sf_dir):
    """Rows whose new date is in another year leave their old partition, one of which is empty then. Values that the batch lacks are kept."""
    rows, path = _orders(spark, sf_dir), tables.new_folder(spark, "orders")
    partitions.merge_partitions(rows, path, ["o_orderkey"], ["y"])
    moved = rows.where("y = 1995 OR (y = 1997 AND o_orderkey % 2 = 0)").withColumn("d", F.date_add("d", 366))
    batch = moved.select("o_orderkey", F.lit(None).cast("long").alias("o_custkey"), "d", F.lit(None).cast("double").alias("price"), F.year("d").alias("y"))
    partitions.merge_partitions(batch, path, ["o_orderkey"], ["y"], tables.upsert_coalesce, moves=True)
    return partitions.read_partitions(spark, path)


_NEW = "1998-01-01"


@register("spans_of_changed_people", f"WITH {S._CHAIN} SELECT * FROM chain_spans")
def spans_of_changed_people(spark, sf_dir):
    """The chain of spans is built on what was known before a day, then for people with news only; the same as if it were built at once.

    Games are line items joined with their orders, and are read five times: by both builds, and to find who changed. They are joined and written once.
    """
    path, seen = tables.new_folder(spark, "spans"), tables.new_folder(spark, "games")
    S._appearances(spark, sf_dir).write.parquet(seen)
    news, games = S._transactions(spark, sf_dir), spark.read.parquet(seen)

    def build(news, games):
        return lambda of: P.build_spans(S.told(P.placements(of(news))), of(news), S._calendar(spark), S._teams(spark), of(games), F.lit(S._AS_OF).cast("date")).drop("side", "injury_length", "currently_injured")

    old = news.where(F.col("date") < _NEW), games.where(F.col("game_date") < _NEW)
    everyone = news.select("person_id").unionByName(games.select("person_id"))
    partitions.rebuild_entities(path, "person_id", everyone, build(*old), 8)
    changed = changed_entities(news, "person_id", "date", old[0], "date", everyone)
    changed = changed.unionByName(changed_entities(games, "person_id", "game_date", old[1], "game_date", everyone))
    partitions.rebuild_entities(path, "person_id", changed, build(news, games), 8)
    return partitions.read_partitions(spark, path).drop("bucket")


@register(
    "backfill_of_missing_days",
    """
    WITH g AS (SELECT CAST(ts AS DATE) AS d, event_type, CAST(count(*) AS BIGINT) AS n, round(sum(value), 6) AS total FROM events GROUP BY 1, 2)
    SELECT d, event_type, n, total, n - (SELECT p.n FROM g p WHERE p.event_type = g.event_type AND p.d = g.d - 1) AS change FROM g
    """,
)
def backfill_of_missing_days(spark, sf_dir):
    """Some days were not landed when the daily table was built; they are found, and only the days that they change are computed again."""
    path = tables.new_folder(spark, "daily")
    events = table(spark, sf_dir, "events").withColumn("d", F.to_date("ts"))

    def daily(rows):
        sums = rows.groupBy("d", "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("total"))
        before = Window.partitionBy("event_type").orderBy("d")
        change = F.when(F.lag("d").over(before) == F.date_sub("d", 1), F.col("n") - F.lag("n").over(before))
        return sums.withColumn("change", change)

    landed = events.where(~F.dayofmonth("d").isin(3, 10, 11, 29))
    partitions.replace_partitions(path, ["d"], landed.select("d"), lambda _: daily(landed))
    missing = missing_dates(events.select("event_id", "d"), landed, "event_id", "d")
    partitions.backfill(path, "d", missing, events, daily, margin=1)
    return partitions.read_partitions(spark, path)


@register(
    "warehouse_run",
    """
    WITH o AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS y, count(*) AS n, round(sum(o_totalprice), 2) AS paid FROM orders GROUP BY 1, 2)
    SELECT o_custkey, CAST(count(*) AS BIGINT) AS n_years, CAST(sum(n) AS BIGINT) AS n_orders, round(sum(paid), 2) AS paid, CAST(max(y) AS INTEGER) AS latest FROM o GROUP BY 1
    """,
)
def warehouse_run(spark, sf_dir):
    """An incremental model in partitions by year, and a table and a view that read it; the second run brings the last years only."""
    home = Warehouse(spark, tables.new_folder(spark, "warehouse"))
    sums = [F.count("*").alias("n"), F.round(F.sum("price"), 2).alias("paid")]
    home.add(Model("yearly", ("orders",), lambda o: o.groupBy("o_custkey", "y").agg(*sums), "incremental", ("o_custkey", "y"), by=("y",), expects=Expectations(not_null=["n"], unique=["o_custkey", "y"])))
    totals = [F.count("*").alias("n_years"), F.sum("n").alias("n_orders"), F.round(F.sum("paid"), 2).alias("paid"), F.max("y").alias("latest")]
    home.add(Model("customers", ("yearly",), lambda y: y.groupBy("o_custkey").agg(*totals), "table", expects=Expectations(unique=["o_custkey"])))
    home.add(Model("customers_shown", ("customers",), lambda c: c, "view"))
    rows = _orders(spark, sf_dir)
    home.run(["customers_shown"], {"orders": rows.where("y < 1997")})
    home.run(["customers_shown"], {"orders": rows.where("y >= 1996")})
    return spark.table("customers_shown")


@register(
    "tables_made_and_filled",
    """
    SELECT n_nationkey, n_name, n_regionkey, CAST(floor(n_nationkey * 1.5) AS INTEGER) AS pay, TIMESTAMP '2024-01-02 03:04:05' AS last_ingested_at FROM nation, range(2) UNION ALL
    SELECT n_nationkey + 100, NULL, n_regionkey, NULL, TIMESTAMP '2024-01-02 03:04:05' FROM nation
    """,
)
def tables_made_and_filled(spark, sf_dir):
    """A table is made empty, filled, emptied and filled again; what it is joined with is read from a seed of fixed rows."""
    path, seed = tables.new_folder(spark, "nations"), tables.new_folder(spark, "seed")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    nation.select("n_nationkey", F.floor(F.col("n_nationkey") * 1.5).alias("pay")).write.option("header", True).csv(seed)
    tables.ensure_table(spark, path, nation.schema)
    stamped = tables.first_ingest(nation, F.lit("2024-01-02 03:04:05").cast("timestamp_ntz")).withColumns({c: F.col(c).cast("timestamp") for c in ("first_ingested_at", "last_ingested_at")})
    tables.append_rows(stamped, path)
    tables.truncate(spark, path)
    for rows in (stamped, stamped, stamped.withColumns({"n_nationkey": (F.col("n_nationkey") + 100).cast(nation.schema["n_nationkey"].dataType), "n_name": F.lit(None).cast("string")})):
        tables.append_rows(rows, path)
    pay = read_seed(spark, seed, "n_nationkey int, pay int")
    out = tables.ensure_table(spark, path, nation.schema).join(F.broadcast(pay), "n_nationkey", "left")  # a seed is small
    return out.select("n_nationkey", "n_name", "n_regionkey", "pay", F.col("last_ingested_at").cast("timestamp_ntz").alias("last_ingested_at"))
