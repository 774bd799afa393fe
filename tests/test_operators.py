import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanweave.functions import scalars as S
from spanweave.operators import aggregates, checks, facets, joins, schemas, tables
from spanweave.operators.joins import asof_join, count_between, overlap_join
from spanweave.operators.windows import island_ids, keep_fewest_nulls
from spanweave.plans.models import Model, Warehouse
from spanweave.plans import outings, reports
from spanweave.sources import landed
from spanweave.streaming import lookback


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_upserts_keep_or_replace_nulls(spark):
    target = spark.createDataFrame([(1, "a", 10)], "k int, s string, n int")
    batch = spark.createDataFrame([(1, None, 20), (2, "b", None), (None, "x", 1)], "k int, s string, n int")
    assert rows(tables.upsert_coalesce(target, batch, ["k"])) == [(1, "a", 20), (2, "b", None)]
    assert rows(tables.upsert_replace(target, batch, ["k"])) == [(1, None, 20), (2, "b", None)]
    wider = batch.withColumn("more", F.lit(True))
    assert rows(tables.upsert_coalesce(target, wider, ["k"])) == [(1, "a", 20, True), (2, "b", None, True)]
    stamped = tables.upsert_coalesce(target.withColumn("at", F.lit("old")), batch.withColumn("at", F.lit("x")), ["k"], touched="at", now=F.lit("now"))
    assert rows(stamped) == [(1, "a", 20, "now"), (2, "b", None, "now")]


def test_types_are_inferred_in_order(spark):
    df = spark.createDataFrame([("Y", "2024-01-02", "2024-01-02T00:00:00Z", "1.0", "1.5", "a", None, 1), ("n", None, None, "2.0", "2", "3", None, 2)], "b string, d string, t string, i string, f string, s string, z string, n int")
    kinds = [f.dataType for f in schemas.infer_types(df)]
    assert kinds == [T.BooleanType(), T.DateType(), T.TimestampType(), T.LongType(), T.DoubleType(), T.StringType(), T.StringType(), T.IntegerType()]
    r = schemas.apply_types(df, schemas.infer_types(df)).first()
    assert (r.b, r.d, r.i, r.f, r.s, r.z) == (True, dt.date(2024, 1, 2), 1, 1.5, "a", None)


def test_drift_is_aligned(spark):
    stored = T.StructType.fromDDL("a bigint, b date")
    batch = spark.createDataFrame([("7", "new"), ("x", "new")], "a string, c string")
    assert rows(schemas.align(batch, stored)) == [(7, None, "new"), (None, None, "new")]
    assert schemas.widen(spark.createDataFrame([(1, None)], stored), batch.schema).columns == ["a", "b", "c"]
    assert schemas.drop_empty_columns(spark.createDataFrame([(1, None)], stored)).columns == ["a"]


def test_nested_pages_are_flattened(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"dates": [{"games": [{"gamePk": 1, "teams": {"home": {"id": 5}}}, {"gamePk": 2, "teams": {"home": {"id": 6}}}]}, {"games": []}]}')
    assert rows(landed.read_json_rows(spark, str(tmp_path / "p.json"), "dates", "games")) == [(1, 5), (2, 6)]


def test_landed_readers(spark):
    feed = spark.createDataFrame([(1, "a", None, 1), (1, "b", None, 2), (None, "c", None, 3)], "Id int, V string, Nothing string, Seq int")
    assert rows(landed.feed(feed, ["id"], F.col("seq"))) == [(1, "b", 2)]
    assert rows(keep_fewest_nulls(spark.createDataFrame([(1, None, None), (1, "a", None), (None, "b", "c")], "id int, x string, y string"), ["id"], [F.col("x")])) == [(1, "a", None)]
    people = spark.createDataFrame([(1, [(5, "2021-01-02", "A", 9), (6, None, "RA", 9), (7, "2021-01-02", "A", 9), (None, None, "A", None)]), (2, None)], "id long, e array<struct<team:long,start:string,status:string,parent:long>>")
    shaped = people.select("id", F.transform("e", lambda e: F.struct(F.struct(e.team.alias("id"), e.parent.alias("parentOrgId")).alias("team"), e.start.alias("startDate"), F.lit(None).cast("string").alias("statusDate"), F.lit(None).cast("string").alias("endDate"), F.lit(True).alias("isActive"), F.struct(e.status.alias("code"), e.status.alias("description")).alias("status"))).alias("rosterEntries"))
    got = landed.roster_entries(shaped, spark.createDataFrame([(5,)], "id long"))
    assert sorted((r.person_id, r.team_id or 0, str(r.start_date)) for r in got.collect()) == [(1, 0, "None"), (1, 5, "2021-01-02"), (1, 6, "None"), (2, 0, "None")]
    bat, pit = spark.createDataFrame([(1, 2.0, 600)], "PlayerId int, WAR double, PA int"), spark.createDataFrame([(2, 3.0), (None, 1.0)], "PlayerId int, WAR double")
    assert rows(landed.two_shapes(bat, pit, ["playerid", "war", "pa"], "position", ("batter", "pitcher"), ["playerid"])) == [(1, 2.0, 600, "batter"), (2, 3.0, None, "pitcher")]
    sheet = spark.createDataFrame([tuple(f"c{i}" for i in range(13))], ", ".join(f"x{i} string" for i in range(13)))
    assert rows(landed.payroll_sheet(sheet, 2019)) == [("c0", "c5", 2019)] and rows(landed.payroll_sheet(sheet, 2020)) == [("c0", "c12", 2020)]
    assert len(rows(landed.per_season(lambda y: bat, [2020, 2021]))) == 2


def test_pages_links_tables_and_addresses(spark):
    html = '<a class="x" href="http://h/payroll/a">Team <b>2019</b> pay</a><a href=\'http://h/other\'>2019</a><a href="http://h/payroll/b">2019 again</a><table></table><table><tr><th>A</th><td> b </td></tr><tr><td>1</td></tr></table>'
    page = spark.createDataFrame([(1, html)], "page int, html string")
    assert rows(landed.yearly_links(page, "html", "payroll")) == [(1, 2019, "http://h/payroll/a")]
    assert page.select(landed.table_rows(F.col("html"), 2)).first()[0] == [["A", "b"], ["1"]]
    page = F.lit("https://docs.google.com/spreadsheets/d/e/2PACX/pubhtml")
    assert spark.range(1).select(landed.csv_export_url(page, F.lit(3))).first()[0] == "https://docs.google.com/spreadsheets/d/e/2PACX/pub?output=csv&gid=3"


def test_chunks_missing_dates_and_changed_entities(spark, tmp_path):
    got = [(str(a), str(b)) for a, b in rows(landed.date_chunks(spark, "2020-11-28", "2021-02-07", 5, ("02-01", "11-30")))]
    assert got == [("2020-11-28", "2020-11-30"), ("2021-02-01", "2021-02-05"), ("2021-02-06", "2021-02-07")]
    log = spark.createDataFrame([(1, "2021-01-01"), (2, "2021-01-20")], "person int, date string")
    known = spark.createDataFrame([(1, "2021-01-22")], "person int, status_date string")
    everyone = spark.createDataFrame([(1,), (2,), (3,)], "person int")
    assert rows(landed.changed_entities(log, "person", "date", known, "status_date", everyone)) == [(2,)]
    assert len(rows(landed.changed_entities(log, "person", "date", known.limit(0), "status_date", everyone))) == 3
    log.write.csv(f"{tmp_path}/ok")
    assert landed.first_readable(spark, [f"{tmp_path}/no", f"{tmp_path}/ok"], lambda s, p: s.read.csv(p)).count() == 2
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        landed.first_readable(spark, [f"{tmp_path}/no"], lambda s, p: s.read.csv(p))


def test_asof_ignores_null_keys_and_slices_agree(spark):
    left = spark.createDataFrame([(1, "a", 1), (2, "a", 5), (3, None, 1), (4, "b", None), (5, "b", 3), (6, "a", 99)], "id int, k string, t int")
    right = spark.createDataFrame([("a", 3, "x"), ("a", 5, "y"), ("a", 5, "w"), (None, 2, "n"), ("b", 3, "z"), ("b", None, "q")], "k string, rt int, v string")
    for slice_by in (None, F.floor(F.col("_ts") / 2)):
        got = {r.id: (r.rt, r.v) for r in asof_join(left, right, ["k"], "t", "rt", tie=["v"], slice_by=slice_by).collect()}
        assert got == {1: (3, "x"), 2: (5, "w"), 3: (None, None), 4: (None, None), 5: (3, "z"), 6: (None, None)}
        strict = {r.id: r.v for r in asof_join(left, right, ["k"], "t", "rt", allow_exact=False, tie=["v"], slice_by=slice_by).collect()}
        assert strict == {1: "x", 2: None, 3: None, 4: None, 5: None, 6: None}
        back = {r.id: r.v for r in asof_join(left, right, ["k"], "t", "rt", direction="backward", tie=["v"], slice_by=slice_by).collect()}
        assert back == {1: None, 2: "w", 3: None, 4: None, 5: "z", 6: "w"}


def test_overlap_bounds_are_open_and_closed(spark):
    d = dt.date
    left = spark.createDataFrame([(1, d(2021, 1, 1), d(2021, 2, 1))], "k int, a date, b date")
    right = spark.createDataFrame([(1, d(2020, 1, 1), d(2021, 1, 1)), (1, d(2021, 2, 1), d(2021, 3, 1))], "k int, x date, y date")
    for days in (None, 10):
        assert [r.x for r in overlap_join(left, right, ["k"], ("a", "b"), ("x", "y"), slice_days=days).collect()] == [d(2021, 2, 1)]
        assert overlap_join(left, right.limit(0), ["k"], ("a", "b"), ("x", "y"), slice_days=days).first().x is None


def test_islands_and_plans_have_no_nested_loops(spark):
    df = spark.createDataFrame([(1, i, b) for i, b in enumerate([True, True, False, False])], "k int, o int, b boolean")
    assert [r.island for r in island_ids(df, ["k"], ["o"], F.col("b")).orderBy("o").collect()] == [1, 1, 1, 2]


def test_facets_and_checks(spark):
    df = spark.createDataFrame([("a", "b"), ("b", None), (None, None), ("c", "a")], "x string, y string")
    options = ["a", "b", "c"]
    assert df.where(facets.facet("x", options, options)).count() == 4
    assert df.where(facets.facet("x", [], options, cleared=True)).count() == 0
    assert df.where(facets.facet("x", [], options)).count() == 4
    assert df.where(facets.facet("x", ["a"], options)).count() == 1
    assert df.where(facets.facet(["x", "y"], ["a"], options)).count() == 2
    assert checks.nulls_in(df, ["x"]).count() == 1 and checks.unaccepted(df, "x", ["a", "b"]).count() == 1
    checks.expect(checks.repeated_keys(df, ["x"]), "x is unique")
    with pytest.raises(AssertionError):
        checks.expect(df, "nothing")


def test_scalars(spark):
    df = spark.createDataFrame([("$1,234", "(1,234)", "x", "Núñez, José", 'Ken "K" Griffey jr.', "A B C", "6' 2\"", 200)], "a string, b string, c string, n string, j string, i string, h string, w int")
    r = df.select(S.money(F.col("a")), S.money(F.col("b")), S.money(F.col("c")), S.ascii_letters(S.given_name_first(F.col("n"))), S.plain_name(F.col("j")), S.without_initial(F.col("i")), S.height_inches(F.col("h")),
                  S.body_mass_index(F.col("w"), F.lit(74), whole=True), S.dollars(F.lit(1234.5)), S.renamed(F.col("c"), {"x": "y"}), S.truth(F.col("c"))).first()
    assert tuple(r)[:7] == (1234, -1234, None, "Jose Nunez", "ken griffey jr", "A B C", 74)
    assert tuple(r)[7:] == (0, "$1,234.50M", "y", False)


def test_top_with_others_and_summaries(spark):
    df = spark.createDataFrame([(f"n{i:02d}", i, "g" if i < 29 else "h", "b", f"t{i % 3}") for i in range(31)], "name string, games_missed int, body_part_group string, body_part string, injury_type string")
    got = {r.name: r.games_missed for r in aggregates.top_with_others(df, "name", "games_missed", 30).collect()}
    assert len(got) == 31 and got["Others"] == 0
    stack = reports.team_players(df, "games_missed", 2).collect()
    assert {r.name for r in stack} == {"n30", "n29", "Others"} and max(r.place for r in stack if r.name == "Others") == 3
    assert {r.injuries for r in stack if r.name == "Others"} == {"(multiple)"}
    assert aggregates.stacked(df, ["body_part_group", "body_part_group"], F.lit(1), "n").orderBy("n").collect()[1].n == 29
    nothing = spark.createDataFrame([("a", None), ("a", None), (None, 1)], "k string, v int")
    assert [tuple(r) for r in aggregates.stacked(nothing, ["k"], F.col("v"), "v").collect()] == [("a", 0)]


def test_warehouse_runs_in_order_and_merges(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    w.add(Model("double", ("raw",), lambda raw: raw.select("k", (F.col("v") * 2).alias("v")), "incremental", ("k",)))
    w.add(Model("total", ("double",), lambda d: d.agg(F.sum("v").alias("v")), "table"))
    w.add(Model("seen", ("total",), lambda t: t, "view"))
    first = w.run(["seen"], {"raw": spark.createDataFrame([(1, 1), (2, 2)], "k int, v int")})
    assert first["seen"].first().v == 6 and w.order(["seen"]) == ["double", "total", "seen"]
    again = w.run(["seen"], {"raw": spark.createDataFrame([(2, 5), (3, 1)], "k int, v int")})
    assert again["total"].first().v == 2 + 10 + 2 and spark.sql("SELECT v FROM seen").first().v == 14


def test_outings_and_history(spark):
    d = dt.date
    events = spark.createDataFrame([(1, 10, d(2021, 4, 1), 5, 90.0), (1, 10, d(2021, 4, 1), 6, 92.0), (1, 11, d(2021, 4, 8), 7, 88.0)], "pitcher int, game int, date date, bat int, speed double")
    got = outings.outings(events, ["pitcher", "game"], "date", ["speed"], "bat").orderBy("date").collect()
    assert [(r.n_bat, r.avg_speed, r.std_speed, r.days_since) for r in got] == [(2, 91.0, 1.0, None), (1, 88.0, 0.0, 7)]
    wide = outings.history_features(spark.createDataFrame([(1, i, float(i * i)) for i in range(5)], "p int, o int, v double"), "p", ["o"], ["v"], 3).orderBy("o").collect()
    assert wide[0].v_mean_3 is None and wide[4].v_mean_3 == pytest.approx((9 + 4 + 1) / 3) and wide[4].v_slope_3 == pytest.approx(-4.0) and wide[4].n_history == 3
    assert wide[4].v_std_3 == pytest.approx(2.5) and wide[1].v_slope_3 is None
    labels = outings.horizon_labels(
        spark.createDataFrame([(1, 1, d(2021, 4, 1)), (1, 2, d(2021, 4, 20))], "p int, g int, d date"), spark.createDataFrame([(1, d(2021, 4, 25))], "p int, hit date"), "p", "d", "hit", [7, 30], ["g"]
    ).orderBy("g").collect()
    assert [(r.last_before, r.within_7d, r.within_30d) for r in labels] == [(False, False, True), (True, True, True)]
    role = spark.createDataFrame([(1, 1, d(2021, 1, 1)), (1, 2, d(2021, 1, 2)), (1, 3, d(2021, 1, 3))], "pitcher int, game int, date date")
    plays = spark.createDataFrame([(1, 5, 1, 1), (2, 5, 1, 1), (3, 5, 9, 1), (3, 5, 1, 2)], "game int, team int, pitcher int, n int")
    got = outings.roles(role, plays, "game", "team", "pitcher", ["n"], "date").orderBy("game").collect()
    assert [(r.role, r.role_switch) for r in got] == [("starter", True), ("starter", False), ("reliever", True)]


def test_streams_merge_by_key(spark, tmp_path):
    schema = "k int, ts timestamp, v string"
    ts = dt.datetime(2024, 1, 1)
    for n, batch in enumerate([[(1, ts, "a"), (2, ts, "b")], [(1, ts + dt.timedelta(hours=1), None), (3, ts + dt.timedelta(hours=1), "c")]]):
        spark.createDataFrame(batch, schema).coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
    q = lookback.merge_into(stream, f"{tmp_path}/t", ["k"], "ts", f"{tmp_path}/c").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert sorted((r.k, r.v) for r in spark.read.parquet(f"{tmp_path}/t").collect()) == [(1, "a"), (2, "b"), (3, "c")]
    chains = lookback.sessions(stream, "k", "ts", "30 minutes", "1 day")
    q = chains.writeStream.outputMode("complete").format("memory").queryName("chains").option("checkpointLocation", f"{tmp_path}/c2").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.sql("SELECT count(*) FROM chains").first()[0] == 4


def test_a_write_that_stops_between_its_renames_loses_nothing(spark, tmp_path):
    path = f"{tmp_path}/t"
    tables.write_version(spark.createDataFrame([(1, "a")], "k int, v string"), path)
    tables.write_version(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), path)
    assert spark.read.parquet(path).count() == 2 and not os.path.exists(f"{path}.last")
    os.rename(path, f"{path}.last")  # as it is after the first rename
    spark.createDataFrame([(9, "z")], "k int, v string").write.parquet(f"{path}.next")
    assert tables.table_exists(spark, path)
    fresh = tables.upsert_coalesce(spark.read.parquet(path), spark.createDataFrame([(3, "c")], "k int, v string"), ["k"])
    tables.write_version(fresh, path)
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == [1, 2, 3]
    os.rename(path, f"{path}.last")
    tables.write_version(spark.createDataFrame([(4, "d")], "k int, v string"), path)
    assert spark.read.parquet(path).count() == 1


def test_tables_are_made_filled_and_emptied(spark, tmp_path):
    path = f"{tmp_path}/t"
    schema = spark.createDataFrame([], "k int, v string").schema
    assert tables.ensure_table(spark, path, schema).columns == ["k", "v", "first_ingested_at", "last_ingested_at"]
    rows = tables.first_ingest(spark.createDataFrame([(1, "a")], schema))
    tables.append_rows(rows, path)
    tables.append_rows(rows, path)
    assert tables.ensure_table(spark, path, schema).count() == 2
    tables.truncate(spark, path)
    assert spark.read.parquet(path).count() == 0 and spark.read.parquet(path).columns[0] == "k"
    with open(f"{tmp_path}/seed.csv", "w") as f:
        f.write("season,min_salary\n2021,570500\n")
    assert [tuple(r) for r in landed.read_seed(spark, f"{tmp_path}/seed.csv", "season int, min_salary long").collect()] == [(2021, 570500)]


def test_sliced_overlaps_equal_plain_ones(spark):
    d = dt.date
    left = spark.createDataFrame([(1, "k", d(2021, 1, 1), d(2021, 6, 1)), (1, "k", d(2021, 1, 1), d(2021, 6, 1)), (2, "k", d(2021, 5, 1), d(2021, 3, 1)), (3, None, d(2021, 1, 1), d(2021, 2, 1)), (4, "k", None, d(2021, 2, 1)), (5, "z", d(2020, 1, 1), d(2020, 1, 1))], "id int, k string, a date, b date")
    right = spark.createDataFrame([("k", d(2021, 2, 1), d(2021, 8, 1), "x"), ("k", d(2021, 2, 1), d(2021, 8, 1), "x"), ("k", d(2021, 4, 15), d(2021, 4, 1), "y"), (None, d(2021, 1, 1), d(2021, 9, 9), "n")], "k string, x date, y date, v string")
    for how in ("inner", "left"):
        got = [sorted(map(str, (tuple(r) for r in overlap_join(left, right, ["k"], ("a", "b"), ("x", "y"), how, slice_days=n).collect()))) for n in (None, 30, 400)]
        assert got[0] == got[1] == got[2] and len(got[0]) == (11 if how == "left" else 8), how


def test_the_latest_row_of_a_key_comes_out(spark, tmp_path):
    ts = dt.datetime(2024, 1, 1)
    for n, batch in enumerate([[(1, ts, "a")], [(1, ts + dt.timedelta(hours=1), "b")], [(1, ts - dt.timedelta(hours=1), "old")]]):
        spark.createDataFrame(batch, "k int, ts timestamp, v string").coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
    stream = spark.readStream.schema("k int, ts timestamp, v string").option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
    q = lookback.latest_in_lookback(stream, ["k"], "ts").writeStream.outputMode("update").format("memory").queryName("latest").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert "b" in {r.v for r in spark.sql("SELECT v FROM latest").collect()}


def test_results_are_kept_for_a_while(spark):
    built = []
    cache = reports.ResultCache(60)
    for _ in range(2):
        assert cache.get("a", lambda: built.append(1) or spark.range(3)).count() == 3
    cache.seconds = 0
    assert cache.get("a", lambda: built.append(1) or spark.range(4)).count() == 4 and len(built) == 2


@pytest.mark.parametrize("slice_days", [None, 1, 3])
def test_points_in_spans_equal_a_count_of_pairs(spark, slice_days):
    rnd = random.Random(5)
    spans = [(i, rnd.choice(["a", "a", "b", None]), a := rnd.randint(0, 12), a + rnd.randint(-2, 9)) for i in range(60)]
    spans += [spans[0], (90, "a", None, 5), (91, "a", 1, None), (92, "none", 0, 12)]
    points = [(rnd.choice(["a", "a", "b", None]), rnd.choice([*range(14), None]), rnd.choice([*range(9), None])) for _ in range(80)]

    def day(c):
        return F.date_add(F.lit("2024-01-01").cast("date"), F.col(c)).alias(c)

    left = spark.createDataFrame(spans, "i int, k string, a int, b int").select("i", "k", day("a"), day("b"))
    right = spark.createDataFrame(points, "k string, t int, x int").select("k", day("t"), "x")
    got = count_between(left, right, ["k"], "a", "b", "t", "x", "n", slice_days)
    assert got.columns == ["i", "k", "a", "b", "n"]
    want = {}
    for i, k, a, b in spans:
        if None not in (k, a, b):
            want[i] = len({x for q, t, x in points if q == k and t is not None and x is not None and a < t <= b})
    assert sorted((r.i, r.n) for r in got.collect()) == sorted((i, n) for i, n in want.items() if n)
    assert count_between(left, right.where(F.lit(False)), ["k"], "a", "b", "t", "x", "n", slice_days).count() == 0


def test_only_keys_with_many_spans_are_sliced(spark, monkeypatch):
    rnd = random.Random(5)
    day = lambda: None if rnd.random() < 0.05 else dt.date(2021, 1, 1) + dt.timedelta(rnd.randrange(400))
    key = lambda: rnd.choice(["a", "a", "a", "b", "c", None])
    left = spark.createDataFrame([(i // 2, key(), day(), day()) for i in range(80)], "id int, k string, a date, b date")
    right = spark.createDataFrame([(key(), day(), day(), i) for i in range(60)], "k string, x date, y date, v int")
    for how in ("inner", "left"):
        want = None
        for limit, n in ((0, None), (0, 20), (12, 20), (1000, 20)):
            monkeypatch.setattr(joins, "SLICED_ROWS", limit)
            got = sorted(str(tuple(r)) for r in overlap_join(left, right, ["k"], ("a", "b"), ("x", "y"), how, slice_days=n).collect())
            want = want or got
            assert got == want, (how, limit)


def test_rows_joined_as_of_stay_partitioned_by_their_key(spark):
    left, right = (spark.range(10).selectExpr("id % 3 AS k", f"id AS {c}") for c in ("t", "s"))
    joined = joins.asof_join(left.repartition("k"), right.repartition("k"), ["k"], "t", "s")
    plan = joined.selectExpr("*", "count(*) OVER (PARTITION BY k) AS n")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2
    narrow = joins.asof_join(left.selectExpr("CAST(k AS INT) AS k", "t"), right, ["k"], "t", "s")
    assert dict(narrow.dtypes)["k"] == "int" and sorted(narrow.collect()) == sorted((i % 3, i, i) for i in range(10))
