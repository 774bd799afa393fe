"""Outings of people in events, their labels, and wide feature tables of their history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanweave.functions.scalars import body_mass_index, surrogate_key
from spanweave.operators.aggregates import pivot_metrics
from spanweave.operators.joins import asof_join, either_key
from spanweave.operators.windows import changed, lag_deltas, recent, recent_mean, recent_slope, recent_stddev


def outings(events: DataFrame, key: Sequence[str], date: str, metrics: Sequence[str], unit: str) -> DataFrame:
    """A row for each key: distinct units, mean and population deviation of each metric, and days since the person's outing before."""
    person = key[0]
    folds = [f(m).alias(f"{n}_{m}") for m in metrics for n, f in (("avg", F.avg), ("std", F.stddev_pop))]
    rows = events.groupBy(*key, date).agg(F.countDistinct(unit).alias(f"n_{unit}"), *folds).withColumn("outing_id", surrogate_key(*key))
    before = F.lag(date).over(Window.partitionBy(person).orderBy(date, *key[1:]))
    return rows.withColumn("days_since", F.datediff(date, before))


def roles(rows: DataFrame, events: DataFrame, game: str, team: str, person: str, order: Sequence[Column | str], date: str) -> DataFrame:
    """Adds role (starter: the first of the team in the game) and role_switch, true for a person's first outing."""
    first = Window.partitionBy(game, team).orderBy(*order)
    opened = events.withColumn("_n", F.row_number().over(first)).where("_n = 1").select(game, F.col(person).alias("_p"), F.lit("starter").alias("_role"))
    opened = opened.withColumnRenamed(game, "_g").distinct()
    out = rows.join(opened, (F.col(game) == F.col("_g")) & (F.col(person) == F.col("_p")), "left").drop("_g", "_p")
    out = out.withColumn("role", F.coalesce("_role", F.lit("reliever"))).drop("_role")
    return out.withColumn("role_switch", changed("role", [person], [date, game]))


def team_game_numbers(games: DataFrame) -> DataFrame:
    """Number of each team's game in its season."""
    rows = either_key(games, ["home_team_id", "away_team_id"], "team_id")
    w = Window.partitionBy("season", "team_id").orderBy("gamedate", "gamepk")
    return rows.select("gamepk", "season", "team_id", "gamedate", F.row_number().over(w).alias("team_game_number"))


def horizon_labels(
    rows: DataFrame, events: DataFrame, person: str, date: str, event_date: str, days: Sequence[int], tie: Sequence[str], subset: Column | None = None, subset_name: str = "arm"
) -> DataFrame:
    """The next event at or after each outing, whether it lies within so many days, and whether the outing is the last before it.

    Beyond the longest of the days there is no event: its columns are null and no outing is the last before it. ``subset``, a condition
    on the event's columns, gives each label once more, for such events only.
    """
    out = asof_join(rows, events, [person], date, event_date)
    w = Window.partitionBy(person, event_date).orderBy(F.col(date).desc(), *(F.col(c).desc() for c in tie))
    near = {n: F.coalesce(F.datediff(event_date, date) <= n, F.lit(False)) for n in days}
    longest = max(days)
    labels = {"last_before": F.col(event_date).isNotNull() & (F.row_number().over(w) == 1) & near[longest], **{f"within_{n}d": c for n, c in near.items()}}
    if subset is not None:
        labels |= {f"{k}_{subset_name}": c & F.coalesce(subset, F.lit(False)) for k, c in labels.items()}
    out = out.withColumns(labels)
    extra = [c for c in events.columns if c not in rows.columns]
    return out.withColumns({c: F.when(F.col(f"within_{longest}d"), F.col(c)) for c in extra})


def kind_metrics(rows: DataFrame, by: Sequence[str], kind: str, kinds: Sequence[str], metrics: Sequence[str], person: str, date: str) -> DataFrame:
    """Metrics of each kind as columns, and their differences to the outing before: one aggregation, one window."""
    wide = pivot_metrics(rows, by, kind, kinds, metrics)
    return lag_deltas(wide, [f"{k}_{m}".lower() for k in kinds for m in metrics], [person], [date])


def history_features(rows: DataFrame, person: str, order: Sequence[str], metrics: Sequence[str], n: int, role_switch: str | None = None, facts: Sequence[str] = ()) -> DataFrame:
    """Features of the last n outings of earlier dates, the first of ``order`` being the date.

    Of each metric the mean, the slope against recency, and of the last n - 1 the deviation and the mean difference to the outing before;
    flags has_outing_t_1 to n; how often ``role_switch`` is true among the last n - 1; and the history as JSON without its nulls, newest first,
    with the columns named by ``facts``.
    """
    rows = lag_deltas(rows, metrics, [person], order)
    kept = [*facts, *([role_switch] if role_switch and role_switch not in facts else []), *metrics, *(f"{m}_delta" for m in metrics)]
    out = recent(rows, kept, [person], order, n, "history", strict=order[0])
    h = F.col("history")
    features = {}
    for m in metrics:
        features |= {f"{m}_mean_{n}": recent_mean(h, m, n), f"{m}_std_{n}": recent_stddev(h, m, n - 1), f"{m}_slope_{n}": recent_slope(h, m, n), f"{m}_avg_delta_{n}": recent_mean(h, f"{m}_delta", n - 1)}
    features |= {f"has_outing_t_{i}": (F.size(h) >= i).cast("int") for i in range(1, n + 1)}
    if role_switch:
        features["role_switch_count"] = F.size(F.filter(h, lambda x: (x["rn"] < n) & x[role_switch]))
    return out.withColumns(features | {"n_history": F.size(h), "history_json": F.to_json(h)}).drop("history", *(f"{m}_delta" for m in metrics))


def prior_spans(rows: DataFrame, spans: DataFrame, person: str, date: str, start: str, fields: Sequence[str], n: int = 5) -> DataFrame:
    """Adds the last n spans of the person that began before each outing, as JSON with the days since, and the days since the latest.

    Each span carries the n up to itself, so that an outing needs its latest span only; of one person no two begin on a day.
    """
    listed = F.collect_list(F.struct(F.col(start).alias("_at"), *fields)).over(Window.partitionBy(person).orderBy(start).rowsBetween(1 - n, 0))
    carried = spans.select(person, F.col(start).alias("_start"), F.reverse(listed).alias("_spans"))
    out = asof_join(rows, carried, [person], date, "_start", direction="backward", allow_exact=False)
    told = F.transform(
        F.coalesce("_spans", F.array().cast(carried.schema["_spans"].dataType)),
        lambda x, i: F.struct((i + 1).cast("int").alias("rn"), F.datediff(F.col(date), x["_at"]).alias("days_since_injury"), *(x[f].alias(f) for f in fields)),
    )
    return out.withColumns({"injuries_json": F.to_json(told, {"ignoreNullFields": "false"}), "days_since_last_injury": F.datediff(date, "_start")}).drop("_start", "_spans")


def static_features(rows: DataFrame, people: DataFrame, person: str, date: str, birth: str, longest_gap: int = 30) -> DataFrame:
    """Adds age in years and, of weight and height, the body mass index; gaps over a month tell nothing and are null."""
    out = rows.join(people, person, "left").withColumn("age", F.datediff(date, birth) / F.lit(365.25))
    if {"weight", "height"} <= set(people.columns):
        out = out.withColumn("bmi", body_mass_index(F.col("weight"), F.col("height")))
    return out.withColumn("days_since", F.when(F.col("days_since") <= longest_gap, F.col("days_since")))


def assembled(outing: DataFrame, key: str, *parts: DataFrame) -> DataFrame:
    """An outing's features from several tables, each with one row of a key; columns that are there already are not taken again."""
    for part in parts:
        outing = outing.join(part.select(key, *(c for c in part.columns if c not in outing.columns)), key, "left")
    return outing
