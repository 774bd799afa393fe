"""Spans on small hand-made tables; expected rows were worked out by hand."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from spanweave.functions import extraction as X
from spanweave.functions.extraction import assumed_side, body_group, parse_injury
from spanweave.operators.checks import expect, overlapping
from spanweave.plans import spans as s



def as_of():
    return F.lit("2022-06-01").cast("date")


D = dt.date.fromisoformat
CALENDAR = [(1, 2020, "2020-07-23", "2020-09-27"), (1, 2021, "2021-04-01", "2021-10-03"), (1, 2022, "2022-04-07", None), (2, 2021, "2021-04-01", "2021-10-03"), (2, 2022, "2022-04-07", None)]


def placed(spark, rows):
    """(trans_id, person, date, team, body part, type)"""
    out = [(i, p, D(d), "text", t, f"raw {i}", "left", part, kind, {"elbow": "elbow", "ucl": "elbow", "knee": "knee", None: None, "undisclosed": "undisclosed"}[part]) for i, p, d, t, part, kind in rows]
    return spark.createDataFrame(out, "il_place_trans_id long, person_id long, il_place_date date, il_place_description string, il_place_team long, raw_injury string, side string, body_part string, injury_type string, body_part_group string")


def log(spark, rows):
    """(trans_id, person, date, description, code, to team)"""
    return spark.createDataFrame([(i, p, D(d), text, code, t) for i, p, d, text, code, t in rows], "trans_id long, person_id long, date date, description string, typecode string, toteam_id long")


def build(spark, placements, transactions, appearances=(), keep=False):
    calendar = spark.createDataFrame([(t, y, D(a), D(b) if b else None) for t, y, a, b in CALENDAR], "team_id long, season long, first_game date, last_game date")
    teams = spark.createDataFrame([(1,), (2,)], "id long")
    seen = spark.createDataFrame([(p, D(d), t) for p, d, t in appearances], "person_id long, game_date date, team_id long")
    out = s.build_spans(placed(spark, placements), log(spark, transactions), calendar, teams, seen, as_of(), keep)
    return sorted(out.collect(), key=lambda r: (r.person_id, r.il_place_date))


def test_returns_caps_and_appearances(spark):
    rows = build(
        spark,
        [(1, 10, "2021-05-01", 1, "elbow", "sprain"), (2, 11, "2021-05-01", 1, "elbow", "sprain"), (3, 12, "2021-05-01", 1, "elbow", "sprain"),
         (4, 13, "2021-09-01", 1, "elbow", "sprain"), (5, 14, "2022-05-01", 1, "elbow", "sprain"), (6, 15, "2015-05-01", 1, "elbow", "sprain"), (7, 16, "2021-05-01", 1, "knee", "sprain")],
        [(100, 10, "2021-05-20", "activated x", "SC", 1), (101, 11, "2021-05-01", "activated x", "SC", 1), (102, 11, "2021-06-01", "reinstated x", "SC", 1),
         (103, 12, "2021-06-01", "activated x", "SC", 1), (104, 16, "2021-05-10", "assigned to all-stars, activated", "ASG", 1), (105, 16, "2021-05-12", "assigned", "ASG", 99), (106, 16, "2021-05-14", "assigned", "ASG", 2)],
        [(12, "2021-05-15", 2), (12, "2021-05-01", 1)],
    )
    got = {r.person_id: r for r in rows}
    assert (got[10].return_date, got[10].injury_length, got[10].currently_injured, got[10].return_trans_id) == (D("2021-05-20"), 19, False, 100)
    assert got[11].return_date == D("2021-06-01")
    assert (got[12].return_date, got[12].return_team, got[12].return_trans_id) == (D("2021-05-15"), 2, None)
    assert (got[13].return_date, got[13].return_team) == (D("2021-10-10"), 1)
    assert (got[14].return_date, got[14].currently_injured, got[14].injury_length) == (None, True, 31)
    assert 15 not in got
    assert (got[16].return_date, got[16].return_team) == (D("2021-05-14"), 2)


@pytest.mark.parametrize(("second", "kind", "spans"), [("ucl", "soreness", 1), ("knee", "soreness", 2), (None, "pain", 1)])
def test_shared_returns_are_bridged_by_body_group(spark, second, kind, spans):
    rows = build(spark, [(1, 10, "2021-06-01", 1, "elbow", "surgery"), (2, 10, "2021-07-01", 1, second, kind)], [(100, 10, "2021-08-01", "activated x", "SC", 1)])
    assert len(rows) == spans
    if spans == 1:
        assert (rows[0].return_date, rows[0].second_injury_type, rows[0].second_body_part) == (D("2021-08-01"), "surgery", "elbow")
    else:
        assert (rows[0].return_date, rows[0].currently_injured, rows[0].injury_length) == (D("2021-07-01"), False, 30)
        kept = build(spark, [(1, 10, "2021-06-01", 1, "elbow", "surgery"), (2, 10, "2021-07-01", 1, second, kind)], [(100, 10, "2021-08-01", "activated x", "SC", 1)], keep=True)
        assert kept[0].currently_injured and kept[0].injury_length == 365


def test_offseason_gap_before_opening_day_is_bridged(spark):
    rows = build(spark, [(1, 10, "2021-09-01", 1, "elbow", "sprain"), (2, 10, "2022-04-01", 1, "elbow", "tear")], [(100, 10, "2022-05-20", "activated x", "SC", 1)])
    assert len(rows) == 1 and (rows[0].return_date, rows[0].second_injury_type) == (D("2022-05-20"), "tear")
    late = build(spark, [(1, 10, "2021-09-01", 1, "elbow", "sprain"), (2, 10, "2022-04-20", 1, "elbow", "tear")], [])
    assert len(late) == 2 and late[0].return_date == D("2021-10-10")
    df = spark.createDataFrame([(r.person_id, r.il_place_date, r.return_date) for r in late], "person_id long, il_place_date date, return_date date")
    expect(overlapping(df, ["person_id"], "il_place_date", F.coalesce("return_date", F.lit("9999-12-31").cast("date"))), "spans exclude each other")


def test_teams_years_games_and_values(spark):
    span = spark.createDataFrame([(1, 10, D("2020-11-20"), D("2022-02-03"), 1)], "il_place_trans_id long, person_id long, il_place_date date, return_date date, il_place_team long")
    rosters = spark.createDataFrame([(10, 1, D("2019-01-01"), D("2020-11-20")), (10, 1, D("2020-11-20"), D("2021-06-30")), (10, 2, D("2021-06-30"), None), (11, 1, D("2019-01-01"), None)], "person_id long, team_id long, start_date date, end_date date")
    teams = s.by_team(span, rosters, as_of())
    got = sorted((r.team_id, r.start_date, r.end_date) for r in teams.collect())
    assert got == [(1, D("2020-11-20"), D("2021-06-30")), (2, D("2021-06-30"), D("2022-02-03"))]
    years = s.by_year(span.withColumnsRenamed({"il_place_date": "start_date", "return_date": "end_date"}))
    assert sorted((r.season, r.start_date, r.end_date) for r in years.collect()) == [(2020, D("2020-11-20"), D("2020-12-31")), (2021, D("2021-01-01"), D("2021-12-31")), (2022, D("2022-01-01"), D("2022-02-03"))]
    games = spark.createDataFrame([(i, 2021, dt.datetime(2021, 5, i, 23, 5), "R", 1 if i % 2 else 3, 3 if i % 2 else 1) for i in range(1, 9)] + [(50, 2021, dt.datetime(2021, 5, 2, 20), "S", 1, 3)], "gamepk long, season int, gamedate timestamp_ntz, gametype string, home_team_id long, away_team_id long")
    slices = spark.createDataFrame([(10, 1, 2021, D("2021-05-01"), D("2021-05-04")), (11, 7, 2021, D("2021-05-01"), D("2021-05-04"))], "person_id long, team_id long, season int, start_date date, end_date date")
    counted = s.games_missed(slices, games).collect()
    assert [(r.person_id, r.games_missed) for r in counted] == [(10, 3)]
    rows = spark.createDataFrame([(1, 2021, 81), (2, 2021, 50), (3, 2021, 200)], "person_id long, season int, games_missed long")
    pay = spark.createDataFrame([(1, 2021, 8_100_000), (3, 2021, 100)], "person_id long, season int, salary long")
    floor = spark.createDataFrame([(2021, 570_500)], "season int, min_salary int")
    war = spark.createDataFrame([(2, 2021, 3.24)], "person_id long, season int, war_per_162 double")
    got = {r.person_id: (float(r.injured_salary), float(r.war_missed)) for r in s.valued(rows, pay, floor, war).collect()}
    assert got == {1: (4.05, 0.3), 2: (0.18, 1.0), 3: (0.57, 0.6)}


def test_calendar_salary_and_projections(spark):
    games = spark.createDataFrame([(1, 2021, D("2021-04-01"), "R", 1, 2), (2, 2021, D("2021-10-03"), "R", 2, 1), (3, 2021, D("2021-03-01"), "S", 1, 2), (4, 2022, D("2022-04-07"), "R", 1, 9)], "gamepk long, season int, gamedate date, gametype string, home_team_id long, away_team_id long")
    teams = spark.createDataFrame([(1,), (2,)], "id long")
    got = sorted((r.team_id, r.season, r.first_game, r.last_game) for r in s.season_calendar(games, teams, as_of()).collect())
    assert got == [(1, 2021, D("2021-04-01"), D("2021-10-03")), (1, 2022, D("2022-04-07"), None), (2, 2021, D("2021-04-01"), D("2021-10-03"))]
    paid = spark.createDataFrame([(1, 2021, 100), (1, 2021, 200), (2, 2021, 900_000), (None, 2021, 5)], "person_id long, season int, salary long")
    floor = spark.createDataFrame([(2021, 570_500)], "season int, min_salary int")
    assert sorted((r.person_id, r.salary) for r in s.salary_by_season(paid, floor).collect()) == [(1, 570_500), (2, 900_000)]
    kinds = [(1, "position player", 700.0, None, None, 2.0), (2, "pitcher", None, 30.0, 30.0, 3.0), (3, "pitcher", None, 60.0, 0.0, 1.0), (4, "pitcher", None, 40.0, 10.0, 1.0), (5, "pitcher", None, 30.0, 1.0, 1.0), (6, "pitcher", None, 30.0, 30.0, 9.0)]
    proj = spark.createDataFrame([(p, 2021, *x) for p, *x in kinds], "person_id long, season int, position string, pa double, games double, games_started double, war double")
    listed = spark.createDataFrame([(1, "SS"), (2, "P"), (3, "P"), (4, "TWP"), (5, "P"), (6, "C")], "person_id long, primaryposition_abbreviation string")
    got = {r.person_id: r.war_per_162 for r in s.projected_value(proj, listed).collect()}
    assert got == pytest.approx({1: 2 / 159 * 162, 2: 3.3, 3: 65 / 60, 4: 57 / 40, 5: 1.0})  # the sixth isn't listed as a pitcher


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Placed RHP x on the 10-day injured list. Right elbow inflammation.", ("right", "elbow", "inflammation", "elbow")),
        ("placed x on the 60-day injured list recovering from tommy john surgery", (None, "ucl", "tear", "elbow")),
        ("left elbow surgery", ("left", "ucl", "tear", "elbow")),
        ("left hand, right thumb sprain", ("right", "thumb", "sprain", "hand")),
        ("concussion", (None, "head", "concussion", "head")),
        ("thoracic outlet syndrome", (None, "shoulder", "thoracic outlet syndrome", "shoulder")),
        ("right oblique", ("right", "oblique", "strain", "torso")),
        ("plantar fasciitis", (None, "foot", "plantar fasciitis", "lower leg")),
        ("partially torn labrum", (None, "labrum", "partial tear", "shoulder")),
        ("nothing known", (None, None, None, None)),
    ],
)
def test_descriptions(spark, text, want):
    r = spark.createDataFrame([(text,)], "t string").select(parse_injury(F.col("t")).alias("p")).select("p.*", body_group(F.col("p.body_part")).alias("g")).first()
    assert tuple(r) == want


def test_assumed_sides(spark):
    rows = [(None, "oblique", "1", "R", "left"), (None, "elbow", "1", "L", "left"), (None, "elbow", "1", "R", "right"), (None, "elbow", "6", "R", None), ("left", "elbow", "1", "R", "left"), (None, "knee", "1", "R", None), (None, "oblique", "Y", "L", "right")]
    df = spark.createDataFrame(rows, "side string, part string, position string, throws string, want string")
    assert df.where(~assumed_side(F.col("side"), F.col("part"), F.col("position"), F.col("throws")).eqNullSafe(F.col("want"))).count() == 0


def test_placements_keep_the_last_of_a_run_and_their_texts(spark):
    rows = [(1, 10, "2021-05-01", "Placed José Núñez on the 10-day injured list.", 1), (2, 10, "2021-05-03", "Placed José Núñez on the 60-day injured list. Left elbow strain", 1),
            (3, 10, "2021-06-01", "activated from the injured list", 1), (4, 11, "2021-05-01", "placed p smith on the injured list", 1), (5, 11, "2021-05-01", "placed p smith on the disabled list. may 3 sore knee", 1)]
    df = spark.createDataFrame([(i, p, D(d), t, team) for i, p, d, t, team in rows], "trans_id long, person_id long, effectivedate date, description string, toteam_id long")
    placed_ = s.placements(df)
    assert sorted(r.il_place_trans_id for r in placed_.collect()) == [2, 5]
    people = spark.createDataFrame([(10, "José Núñez", "j nunez", "1", "R"), (11, "Pat Smith", "p smith", "6", "L")], "person_id long, fullname string, secondary_name string, primaryposition_code string, pitchhand_code string")
    got = {r.person_id: r for r in s.described(placed_, people, ["Bears"]).collect()}
    assert (got[10].raw_injury, got[10].side, got[10].body_part, got[10].injury_type, got[10].body_part_group) == ("elbow strain", "left", "elbow", "strain", "elbow")
    assert (got[11].raw_injury, got[11].body_part, got[11].injury_type) == ("sore knee", "knee", "soreness")


def test_severe_second_description_goes_first(spark):
    df = spark.createDataFrame([(1, "a", "elbow", "strain", "b", "ucl", "tear"), (2, "a", "elbow", "strain", "b", "ucl", "partial tear"), (3, "a", "elbow", "strain", None, None, None)], "id int, raw_injury string, body_part string, injury_type string, second_raw_injury string, second_body_part string, second_injury_type string")
    got = {r.id: (r.raw_injury, r.injury_type, r.second_injury_type) for r in s.severe_first(df).collect()}
    assert got == {1: ("b", "tear", "strain"), 2: ("a", "strain", "partial tear"), 3: ("a", "strain", None)}


def test_values_next_to_half_a_cent_are_rounded_as_in_sql(spark, tmp_path):
    import oracle

    from spanweave.plans import catalog, span_queries

    prices = [109458.0, *(109000.0 + 11 * i for i in range(3000))]
    ts = dt.datetime(1995, 3, 1)
    spark.createDataFrame([(i, i, "F", p, ts) for i, p in enumerate(prices)], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(len(prices)).select(F.col("id").alias("c_custkey")).write.parquet(f"{tmp_path}/customer.parquet")
    sql = catalog.oracle_sql()["span_values"]
    mine, theirs = oracle.both(spark, oracle.connect(str(tmp_path)), span_queries.span_values, sql, str(tmp_path))
    assert mine == theirs and len(mine) == len(prices)


def test_terms_are_found_as_by_a_list_of_them(spark):
    rnd = random.Random(3)
    terms = list(dict.fromkeys([*X.SIDES, *X.BODY_TERMS, *X.INJURY_TERMS]))
    parts = [*terms, "x", "10-day", "-", "_", "tommy", "ulnar collateral"]
    texts = ["".join(rnd.choice(parts) + rnd.choice([" ", " ", "", "-", "."]) for _ in range(8)) for _ in range(2000)]
    plain = re.compile(rf"(?<![a-z0-9])({'|'.join(re.escape(t) for t in sorted(terms, key=lambda t: (-len(t), t)))})(?![a-z0-9])")
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", X.mentions(F.col("t"), terms).alias("found")).collect()
    assert all(r.found == plain.findall(r.t) for r in rows)
    assert X._trie(["tear", "torn", "t", "a-b"]) == r"(?:t(?:ear|orn)?|a\-b)"
