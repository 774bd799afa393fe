"""Report queries over a table of spans by team and season: filters, groups, rankings."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanweave.functions.scalars import dollars, one_decimal
from spanweave.operators.aggregates import distinct_text, first_known, order_categories, stacked, top_n, top_with_others, with_totals
from spanweave.operators.facets import facet
from spanweave.operators.joins import fill_wanted

METRICS = ("games_missed", "injury_count", "injured_salary", "war_missed")


def metric(name: str) -> Column:
    return F.lit(1) if name == "injury_count" else F.col(name)


def league_bars(rows: DataFrame, filters: Sequence[Column], x: str, color: str, name: str) -> DataFrame:
    """A metric by two dimensions, with each category's place on the axis."""
    for f in filters:
        rows = rows.where(f)
    return order_categories(stacked(rows, [x, color], metric(name), name), x, name)


def league_summary(rows: DataFrame, dim: str) -> DataFrame:
    """All metrics of each category, and a row Total, from one scan; a table without rows has no total."""
    return with_totals(rows.where(F.col(dim).isNotNull()), [dim], [F.sum(metric(m)).alias(m) for m in METRICS])


def options(rows: DataFrame, *columns: str) -> DataFrame:
    """The distinct values of one column, or of several together, trimmed and in order."""
    value = F.explode(F.array(*(F.trim(F.col(c).cast("string")) for c in columns)))
    return rows.select(value.alias("value")).where("value <> ''").distinct().orderBy("value")


def league_table(rows: DataFrame, filters: Sequence[Column], x: str, color: str, name: str) -> DataFrame:
    """The bars as a table in the chart's order: one dimension by its total; of two each by its own total, a season by itself."""
    for f in filters:
        rows = rows.where(f)
    sums = stacked(rows, [x, color], metric(name), name)
    for d in dict.fromkeys([x, color]):
        sums = order_categories(sums, d, name).withColumnRenamed("place", f"{d}_place")
    order = [F.col(d if d == "season" and x != color else f"{d}_place") for d in dict.fromkeys([x, color])]
    return sums.orderBy(*order)


def shown(rows: DataFrame, name: str) -> DataFrame:
    """A metric as it is displayed: money in millions, value with one decimal, counts whole."""
    text = {"injured_salary": dollars(F.col(name)), "war_missed": one_decimal(F.col(name))}.get(name, F.col(name).cast("bigint").cast("string"))
    return rows.withColumn(f"{name}_shown", text)


def team_players(rows: DataFrame, name: str, n: int = 30, by: str = "body_part_group") -> DataFrame:
    """A team's metric by one dimension and player, the players beyond the first n as Others, whose injuries are (multiple)."""
    best = top_with_others(rows.where(F.col("name").isNotNull()).withColumn("_v", metric(name)), "name", "_v", n).where("name <> 'Others'").select("name", F.lit(True).alias("_best"))
    labelled = rows.where(F.col("name").isNotNull() & F.col(by).isNotNull()).join(best, "name", "left")
    labelled = labelled.withColumn("name", F.when(F.col("_best"), F.col("name")).otherwise("Others"))
    pair = F.concat_ws(" ", "body_part", "injury_type")
    grouped = labelled.withColumn("_pair", F.when(pair != "", pair)).groupBy(by, "name").agg(F.sum(metric(name)).alias(name), distinct_text("_pair").alias("injuries"))
    grouped = grouped.withColumn("injuries", F.when(F.col("name") == "Others", "(multiple)").otherwise(F.col("injuries")))
    return order_categories(grouped, "name", name)


def player_totals(rows: DataFrame) -> DataFrame:
    """A player's games, pay and value missed over all seasons, zero without a row."""
    return rows.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("games_missed", "injured_salary", "war_missed")))


def team_summary(rows: DataFrame, dim: str, wanted: Sequence[str]) -> DataFrame:
    """Metrics of the wanted categories in turn, zeros for those without a row."""
    sums = rows.groupBy(dim).agg(*(F.sum(metric(m)).alias(m) for m in METRICS))
    return fill_wanted(sums, dim, wanted, METRICS)


def player_seasons(rows: DataFrame) -> DataFrame:
    return rows.groupBy("season").agg(*(F.sum(metric(m)).alias(m) for m in METRICS), F.sum("days_injured").alias("days_injured")).orderBy("season")


def player_body_parts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("season", F.coalesce("body_part", F.lit("Unknown")).alias("body_part")).agg(F.sum("games_missed").alias("games_missed"))


def career(rows: DataFrame, fallback: Column) -> DataFrame:
    """First and last year of each player, the last being ``fallback`` while unknown."""
    return rows.groupBy("person_id").agg(F.min("debut_year").alias("first_year"), F.coalesce(F.max("last_year"), F.first(fallback)).alias("last_year"))


def spans_folded(rows: DataFrame) -> DataFrame:
    """Each span over its teams and seasons."""
    order = F.col("start_date")
    return rows.groupBy("injury_span_sk").agg(
        F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date"),
        *(F.sum(c).alias(c) for c in ("days_injured", "games_missed", "injured_salary", "war_missed")),
        *(first_known(c, order).alias(c) for c in ("name", "raw_injury", "side", "body_part", "body_part_group", "injury_type") if c in rows.columns),
        F.bool_or("currently_injured").alias("currently_injured"),
    )


def leaderboard(rows: DataFrame, name: str, n: int, careers: bool) -> DataFrame:
    """The n greatest spans or careers by a metric."""
    if careers:
        rows = rows.groupBy("person_id", "name").agg(*(F.sum(metric(m)).alias(m) for m in METRICS))
        return top_n(rows, [F.col(name).desc_nulls_last(), F.col("name"), F.col("person_id")], n)
    return top_n(rows.withColumn("injury_count", F.lit(1)), [F.col(name).desc_nulls_last(), F.col("injury_span_sk")], n)


def filtered(rows: DataFrame, chosen: dict[str | tuple[str, ...], tuple[Sequence, Sequence, bool]]) -> DataFrame:
    """Rows that pass every facet: (selected, options, cleared) by column or columns."""
    for columns, (selected, everything, cleared) in chosen.items():
        rows = rows.where(facet(columns if isinstance(columns, str) else list(columns), selected, everything, cleared))
    return rows


def where_equal(rows: DataFrame, **values) -> DataFrame:
    """Rows with these values, given as parameters."""
    names = list(values)
    clause = " AND ".join(f"{c} = :{c}" for c in names) or "TRUE"
    return rows.sparkSession.sql(f"SELECT * FROM {{rows}} WHERE {clause}", args=values, rows=rows)


class ResultCache:
    """Results kept in the session for some seconds, by name; an older one is built anew."""

    def __init__(self, seconds: float = 300):
        self.seconds = seconds
        self._kept: dict[str, tuple[float, DataFrame]] = {}

    def get(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        found = self._kept.get(name)
        if found and time.monotonic() - found[0] < self.seconds:
            return found[1]
        if found:
            found[1].unpersist()
        self._kept[name] = (time.monotonic(), build().persist())
        return self._kept[name][1]
