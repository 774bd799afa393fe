"""Spans of absence from placement and activation events, and what they cost.

All of it is lazy: as-of joins, windows and equality joins. ``as_of`` stands for the day of the report.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanweave.functions.extraction import assumed_side, body_group, is_activation, is_placement, parse_injury, raw_description
from spanweave.functions.scalars import ascii_letters, round_half_away, surrogate_key
from spanweave.operators.joins import asof_join, clip, count_between, either_key, overlap_join
from spanweave.operators.windows import island_ids, keep_first, last_in_group, last_known

UNDISCLOSED = "undisclosed"


def placements(transactions: DataFrame) -> DataFrame:
    """Placements, only the last of a run of them, and one for each person and day."""
    rows = transactions.where(F.col("description").isNotNull())
    w = Window.partitionBy("person_id").orderBy("effectivedate", "trans_id")
    rows = rows.withColumn("_is", is_placement(F.col("description")))
    last = rows.withColumn("_next", F.lead("_is", 1, False).over(w)).where("_is AND NOT _next")
    first = keep_first(last, ["person_id", "effectivedate"], [F.col("trans_id").asc()])
    return first.select(F.col("trans_id").alias("il_place_trans_id"), "person_id", F.col("effectivedate").alias("il_place_date"), F.lower("description").alias("il_place_description"), F.col("toteam_id").alias("il_place_team"))


def described(placed: DataFrame, players: DataFrame, team_names: list[str]) -> DataFrame:
    """Placements with side, body part, injury type, group and the cleaned text; people without a name are left out."""
    people = players.select("person_id", ascii_letters(F.lower("fullname")).alias("_full"), ascii_letters(F.lower("secondary_name")).alias("_second"), "primaryposition_code", "pitchhand_code")
    rows = placed.join(people, "person_id").where("_full IS NOT NULL AND _second IS NOT NULL")
    rows, text = rows.withColumn("_text", ascii_letters(F.col("il_place_description"))), F.col("_text")
    rows = rows.withColumns({"_p": parse_injury(text), "raw_injury": raw_description(text, [F.col("_full"), F.col("_second")], [t.lower() for t in team_names])})
    rows = rows.withColumn("body_part_group", body_group(F.col("_p.body_part")))
    side = assumed_side(F.col("_p.side"), F.col("_p.body_part"), F.col("primaryposition_code"), F.col("pitchhand_code"))
    nothing = F.col("raw_injury") == UNDISCLOSED

    def shown(c: Column) -> Column:
        return F.when(nothing, UNDISCLOSED).otherwise(c)

    return rows.select(*placed.columns, "raw_injury", shown(side).alias("side"), shown(F.col("_p.body_part")).alias("body_part"), shown(F.col("_p.injury_type")).alias("injury_type"), "body_part_group")


def activations(placed: DataFrame, transactions: DataFrame, calendar: DataFrame, teams: DataFrame, reset_all: bool = False) -> DataFrame:
    """Adds return_trans_id, return_date and return_team_id: the first event off the list after the placement, within the season.

    A return later than a week after the season, or none in a season that has ended, is set to that week's end. If placements share a return
    date, the earliest loses it (with ``reset_all`` all but the latest). Placements of a season without a calendar are left out.
    """
    known = teams.select(F.col("id").alias("toteam_id"), F.lit(True).alias("_known")).distinct()
    off = transactions.join(F.broadcast(known), "toteam_id", "left").where(is_activation(F.col("description"), F.col("typecode"), F.col("_known").isNotNull()))
    off = off.select("person_id", F.col("date").alias("return_date"), F.col("trans_id").alias("return_trans_id"), F.col("toteam_id").alias("return_team_id"))
    rows = asof_join(placed, off, ["person_id"], "il_place_date", "return_date", allow_exact=False, tie=["return_trans_id"])
    ends = calendar.groupBy(F.col("season").alias("_season")).agg(F.max(F.col("last_game")).cast("date").alias("_last"))
    rows = rows.join(F.broadcast(ends), F.year("il_place_date") == F.col("_season"))
    cap = F.date_add("_last", 7)
    late = F.coalesce((F.col("return_date") > cap) | (F.col("return_date").isNull() & F.col("_last").isNotNull()), F.lit(False))
    rows = rows.withColumns({"return_team_id": F.when(late, F.col("il_place_team")).otherwise(F.col("return_team_id")), "return_date": F.when(late, cap).otherwise(F.col("return_date"))})
    shared = Window.partitionBy("person_id", "return_date")
    edge = F.col("il_place_date") < F.max("il_place_date").over(shared) if reset_all else F.col("il_place_date") == F.min("il_place_date").over(shared)
    lost = F.col("return_date").isNotNull() & (F.count("*").over(shared) > 1) & edge
    return rows.withColumn("_lost", lost).withColumn("return_date", F.when(~F.col("_lost"), F.col("return_date"))).drop("_season", "_last", "_lost")


def appearance_override(rows: DataFrame, appearances: DataFrame) -> DataFrame:
    """An appearance after the placement and before the return is the return."""
    seen = appearances.select("person_id", F.col("game_date").alias("_game"), F.col("team_id").alias("_team"))
    rows = asof_join(rows, seen, ["person_id"], "il_place_date", "_game", allow_exact=False, tie=["_team"])
    early = F.coalesce(F.col("_game") < F.col("return_date"), F.lit(False))
    changed = {
        "return_team_id": F.when(early, F.col("_team")).otherwise(F.col("return_team_id")),
        "return_trans_id": F.when(~early, F.col("return_trans_id")),
        "return_date": F.when(early, F.col("_game")).otherwise(F.col("return_date")),
    }
    return rows.withColumn("_early", early).withColumns({k: v for k, v in changed.items()}).drop("_game", "_team", "_early")


def bridge(rows: DataFrame, calendar: DataFrame, as_of: Column) -> DataFrame:
    """Related spans of a person as one, with the latest severe (else the last) description as the second one."""
    order = ["il_place_date", "il_place_trans_id"]
    w = Window.partitionBy("person_id").orderBy(*order)
    rows = rows.withColumns({"_next": F.lead("il_place_date").over(w), "_next_team": F.lead("il_place_team").over(w), "_next_group": F.lead("body_part_group").over(w)})
    games = calendar.select(F.col("season").alias("_s"), F.col("team_id").alias("_t"), F.col("first_game").cast("date").alias("_first"), F.col("last_game").cast("date").alias("_last"))
    this = F.broadcast(games.drop("_first"))
    rows = rows.join(this, (F.year("il_place_date") == F.col("_s")) & (F.col("return_team_id") == F.col("_t")), "left").drop("_s", "_t")
    nxt = F.broadcast(games.drop("_last"))
    rows = rows.join(nxt, (F.year("il_place_date") + 1 == F.col("_s")) & (F.col("_next_team") == F.col("_t")), "left").drop("_s", "_t")
    offseason = F.coalesce(F.col("return_date").between(F.col("_last"), F.make_date(F.year("_last"), F.lit(12), F.lit(31))), F.lit(False))
    before_opening = F.coalesce((F.col("_next") <= F.col("_first")) & (F.year("_next") == F.year("_first")), F.lit(False))

    def unknown(c: str) -> Column:
        return F.col(c).isNull() | (F.col(c) == UNDISCLOSED)

    rows = rows.withColumn("_group", F.when(~unknown("body_part_group"), F.col("body_part_group")))
    rows = rows.withColumn("_prior", last_known("_group", ["person_id"], order))
    now, then = unknown("body_part_group"), unknown("_next_group")
    related = (F.col("body_part_group") == F.col("_next_group")) | (~now & then) | (now & ~then & (F.col("_prior") == F.col("_next_group"))) | (now & then)
    edge = ((F.col("return_date").isNull() & F.col("_next").isNotNull()) | (offseason & before_opening)) & F.coalesce(related, F.lit(False))
    rows = island_ids(rows.withColumn("_bridge", F.coalesce(edge, F.lit(False))), ["person_id"], order, F.col("_bridge"), "_chain")
    key = ["person_id", "_chain"]
    severe = F.coalesce(F.lower("injury_type").rlike("surgery|tear"), F.lit(False))
    group = Window.partitionBy(*key)
    worst = F.max(F.when(severe, F.struct(*order, "raw_injury", "body_part", "injury_type"))).over(group)
    rows = rows.withColumns({"_worst": worst, "_chained": F.bool_or("_bridge").over(group), "_n": F.row_number().over(group.orderBy(*order))})
    rows = rows.withColumns({f"_l_{c}": last_in_group(c, key, order) for c in ("return_date", "return_trans_id", "body_part", "injury_type", "raw_injury", "body_part_group")})
    first = rows.where("_n = 1")

    def second(c: str) -> Column:
        return F.when(F.col("_chained"), F.coalesce(F.col(f"_worst.{c}"), F.col(f"_l_{c}"))).alias(f"second_{c}")

    def chained(c: str) -> Column:
        return F.when(F.col("_chained"), F.col(f"_l_{c}")).otherwise(F.col(c)).alias(c)

    spans = first.select(
        "il_place_trans_id", "il_place_date", "person_id", "il_place_team", "raw_injury", "side", "body_part", "injury_type",
        F.coalesce("body_part_group", "_l_body_part_group").alias("body_part_group"),
        second("raw_injury"), second("body_part"), second("injury_type"),
        chained("return_trans_id"), chained("return_date"), F.col("return_team_id").alias("return_team"),
    )
    return measured(spans, as_of)


def measured(spans: DataFrame, as_of: Column) -> DataFrame:
    return spans.withColumns({"injury_length": F.datediff(F.coalesce("return_date", as_of), "il_place_date").cast("bigint"), "currently_injured": F.col("return_date").isNull()})


def close_gaps(spans: DataFrame, as_of: Column, keep_measures: bool = False) -> DataFrame:
    """An open span ends where the person's next one begins; with ``keep_measures`` length and currency stay those from before."""
    w = Window.partitionBy("person_id").orderBy("il_place_date", "il_place_trans_id")
    closed = spans.withColumn("_next", F.lead("il_place_date").over(w)).withColumn("return_date", F.coalesce("return_date", "_next")).drop("_next")
    return closed if keep_measures else measured(closed, as_of)


def build_spans(placed: DataFrame, transactions: DataFrame, calendar: DataFrame, teams: DataFrame, appearances: DataFrame, as_of: Column, keep_measures: bool = False) -> DataFrame:
    rows = appearance_override(activations(placed, transactions, calendar, teams), appearances)
    return close_gaps(bridge(rows, calendar, as_of), as_of, keep_measures)


def severe_first(spans: DataFrame) -> DataFrame:
    """A second description that is a tear or surgery changes places with the first."""
    swap = F.col("second_injury_type").isin("tear", "surgery")
    out = {}
    for c in ("raw_injury", "body_part", "injury_type"):
        out[c] = F.when(swap, F.col(f"second_{c}")).otherwise(F.col(c))
        out[f"second_{c}"] = F.when(swap, F.col(c)).otherwise(F.col(f"second_{c}"))
    return spans.select(*(out[c].alias(c) if c in out else F.col(c) for c in spans.columns))


def by_team(spans: DataFrame, rosters: DataFrame, as_of: Column) -> DataFrame:
    """Spans cut to the times on each team's roster; of equal parts that of the latest status stays.

    Roster rows with status_code RA, or none, don't count; rosters without the columns status_code, status_date or roster_sk are taken as they are.
    """
    left = spans.withColumn("_end", F.coalesce("return_date", as_of))
    if "status_code" in rosters.columns:
        rosters = rosters.where("status_code <> 'RA'")
    ranks = [F.col(c).alias(f"_{c}") for c in ("status_date", "roster_sk") if c in rosters.columns]
    other = rosters.select("person_id", "team_id", F.col("start_date").alias("_start"), F.coalesce("end_date", as_of).alias("_stop"), *ranks)
    rows = overlap_join(left, other, ["person_id"], ("il_place_date", "_end"), ("_start", "_stop"))
    start, end = clip(F.col("il_place_date"), F.col("_end"), F.col("_start"), F.col("_stop"))
    rows = rows.withColumns({"team_id": F.coalesce("team_id", "il_place_team"), "start_date": start, "end_date": end})
    key = ["person_id", "injury_span_sk" if "injury_span_sk" in spans.columns else "il_place_date", "team_id", "start_date", "end_date"]
    latest = [F.col(f"_{c}").desc_nulls_last() for c in ("status_date", "roster_sk") if c in rosters.columns]
    one = keep_first(rows, key, [*latest, F.col("_start").asc_nulls_last(), F.col("_stop").asc_nulls_last(), F.col("il_place_trans_id").asc()])
    return one.drop("_end", "_start", "_stop", "_status_date", "_roster_sk")


def by_year(spans: DataFrame, start: str = "start_date", end: str = "end_date", season: str = "season") -> DataFrame:
    """A row for each calendar year that a span touches, cut to it."""
    rows = spans.where(F.col(start) <= F.col(end)).withColumn(season, F.explode(F.sequence(F.year(start), F.year(end))))
    low, high = F.make_date(F.col(season), F.lit(1), F.lit(1)), F.make_date(F.col(season), F.lit(12), F.lit(31))
    a, b = clip(F.col(start), F.col(end), low, high)
    return rows.withColumns({"_a": a, "_b": b}).drop(start, end).withColumnsRenamed({"_a": start, "_b": end})


COUNTED_GAMES = ("R", "F", "D", "L", "W")


def games_missed(slices: DataFrame, games: DataFrame) -> DataFrame:
    """Distinct games of the team in (start, end]; slices without any are left out."""
    played = either_key(games.where(F.col("gametype").isin(*COUNTED_GAMES)), ["home_team_id", "away_team_id"], "team_id")
    return count_between(slices, played.select("season", "team_id", "gamedate", "gamepk"), ["season", "team_id"], "start_date", "end_date", "gamedate", "gamepk", "games_missed")


def valued(rows: DataFrame, salary: DataFrame, minimum: DataFrame, projections: DataFrame) -> DataFrame:
    """Adds injured_salary in millions and war_missed, of a season of 162 games."""
    out = rows.join(salary, ["person_id", "season"], "left").join(F.broadcast(minimum), "season", "left").join(projections, ["person_id", "season"], "left")
    pay = F.greatest(F.coalesce("salary", F.lit(0)), F.col("min_salary")).cast("double")
    share = F.when(F.col("games_missed") > 162, pay).otherwise(pay * F.col("games_missed") / 162)
    war = F.coalesce("war_per_162", F.lit(0.5)).cast("double") * F.col("games_missed") / 162
    return out.withColumns({"injured_salary": round_half_away(share / 1_000_000, 2).cast("decimal(18,2)"), "war_missed": round_half_away(war, 1).cast("decimal(9,1)")}).drop("salary", "min_salary", "war_per_162")


def season_calendar(games: DataFrame, teams: DataFrame, as_of: Column, left_out: tuple[str, ...] = ("S", "E")) -> DataFrame:
    """First and last game of each team and season; the last is null before November of the season under way."""
    played = either_key(games.where(~F.col("gametype").isin(*left_out)), ["home_team_id", "away_team_id"], "team_id")
    played = played.join(F.broadcast(teams.select(F.col("id").alias("team_id")).distinct()), "team_id", "left_semi")
    ends = played.groupBy("team_id", "season").agg(F.min("gamedate").alias("first_game"), F.max("gamedate").alias("last_game"))
    open_ = (F.col("season") == F.year(as_of)) & (F.month(as_of) < 11)
    return ends.withColumn("last_game", F.when(~open_, F.col("last_game")))


def salary_by_season(salary: DataFrame, minimum: DataFrame) -> DataFrame:
    """A person's pay of a season, not under the minimum."""
    paid = salary.where("person_id IS NOT NULL").groupBy("person_id", "season").agg(F.sum("salary").alias("salary"))
    rows = paid.join(F.broadcast(minimum), "season", "left")
    return rows.withColumn("salary", F.when(F.col("salary") < F.col("min_salary"), F.col("min_salary")).otherwise(F.col("salary"))).drop("min_salary")


def clean_projections(projections: DataFrame) -> DataFrame:
    """At most 700 plate appearances; games that are missing from plate appearances, 4.4 a game."""
    pa = F.when(F.col("pa") > 700, 700).otherwise(F.col("pa"))
    return projections.withColumns({"pa": pa, "games": F.coalesce("games", F.round(F.col("pa") / 4.4, 0))})


def full_season_games(position: Column, games: Column, started: Column) -> Column:
    """Games of a full season in a role: 162 for a position player, 33 starts, 65 in relief, a blend by the share of starts; else the games given."""
    share = F.try_divide(started, games)
    pitcher = position == "pitcher"
    return (
        F.when(games > 162, 162)
        .when(position == "position player", 162)
        .when(pitcher & (started == games) & (started < 33), 33)
        .when(pitcher & (started == 0) & (games < 65), 65)
        .when(pitcher & (started > 1), F.round(33 * share + 65 * (1 - share), 0))
        .otherwise(games)
    )


def fits_position(listed: Column, projected: Column) -> Column:
    """Whether a projection is of the role that a player is listed in; two-way players have both."""
    return ((listed == "P") & (projected == "pitcher")) | ((listed != "P") & (projected == "position player")) | (listed == "TWP")


def projected_value(projections: DataFrame, players: DataFrame) -> DataFrame:
    """Sums of each person and season over their roles, and war_per_162: the value by game times the games of a full season.

    ``players`` has person_id and primaryposition_abbreviation; projections of other people, or of a role that isn't theirs, don't count.
    """
    listed = players.select("person_id", "primaryposition_abbreviation")
    rows = clean_projections(projections).join(listed, "person_id").where(fits_position(F.col("primaryposition_abbreviation"), F.col("position")))
    full = full_season_games(F.col("position"), F.col("games"), F.col("games_started"))
    rows = rows.withColumns({"full_season_games": full, "_per_game": F.try_divide("war", "games")})
    sums = [F.sum(c).alias(c) for c in ("pa", "games", "games_started", "war")]
    per_162 = F.sum(F.col("_per_game") * F.col("full_season_games")).alias("war_per_162")
    return rows.groupBy("person_id", "season").agg(F.max("position").alias("position"), *sums, F.sum("_per_game").alias("war_per_g"), F.sum("full_season_games").alias("full_season_games"), per_162)


def span_totals(rows: DataFrame) -> DataFrame:
    """Of each span over its teams and seasons: ends, sums, and the descriptions; an end is null if any part is open."""
    ends = F.when(F.sum(F.col("end_date").isNull().cast("int")) > 0, None).otherwise(F.max("end_date"))
    same = [F.max(c).alias(c) for c in ("name", "side", "body_part", "injury_type", "body_part_group", "second_body_part", "second_injury_type") if c in rows.columns]
    return rows.groupBy("injury_span_sk").agg(*same, F.min("start_date").alias("start_date"), ends.alias("end_date"), *(F.sum(c).alias(c) for c in ("games_missed", "injured_salary", "war_missed") if c in rows.columns))


def with_span_key(spans: DataFrame) -> DataFrame:
    return spans.withColumn("injury_span_sk", surrogate_key("person_id", "il_place_date"))
