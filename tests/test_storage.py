import datetime as dt
import json
import os
import random
import statistics
import time

import pytest
from pyspark.sql import functions as F

from spanweave.operators import partitions, tables
from spanweave.operators.checks import Expectations
from spanweave.plans import storage_queries, wide, wide_queries
from spanweave.plans.models import Model, Warehouse
from spanweave.streaming import lookback


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_only_touched_partitions_are_written(spark, tmp_path):
    path = f"{tmp_path}/t"
    base = spark.range(60).select(F.col("id").alias("k"), F.lit("a").alias("v"), (F.col("id") % 6).cast("int").alias("p"))
    partitions.merge_partitions(base, path, ["k"], ["p"])
    before = files(path)
    time.sleep(0.02)
    batch = spark.createDataFrame([(1, "b", 1), (100, "n", 1), (None, "x", 4)], "k long, v string, p int")
    partitions.merge_partitions(batch, path, ["k"], ["p"])
    after = files(path)
    assert {f for f in before if "p=1" not in f} == {f for f in after if "p=1" not in f} and all(after[f] == before[f] for f in after if "p=1" not in f)
    assert not {f for f in before if "p=1" in f} & set(after)
    assert rows(partitions.read_partitions(spark, path)) == rows(tables.upsert_replace(base, batch, ["k"]))
    assert not os.path.exists(f"{path}.parts") and not os.path.exists(f"{path}.touched")
    plan = spark.read.parquet(path).where(partitions._is(["p"], [(1,), (2,)]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [p" in plan


def test_a_key_that_moves_leaves_its_old_partition(spark, tmp_path):
    path = f"{tmp_path}/t"
    partitions.merge_partitions(spark.createDataFrame([(1, "a", "x", 1), (2, "b", "y", 1), (3, "c", None, 2)], "k int, v string, p string, q int"), path, ["k"], ["p", "q"])
    batch = spark.createDataFrame([(1, None, "y", 1), (3, "d", "z", 2)], "k int, v string, p string, q int")
    partitions.merge_partitions(batch, path, ["k"], ["p", "q"], tables.upsert_coalesce, moves=True)
    assert rows(partitions.read_partitions(spark, path).select("k", "v", "p", "q")) == [(1, "a", "y", 1), (2, "b", "y", 1), (3, "d", "z", 2)]
    assert sorted(os.listdir(path))[-2:] == ["p=y", "p=z"] or not os.path.exists(f"{path}/p=x/q=1")
    partitions.merge_partitions(batch.where("k = 9"), path, ["k"], ["p", "q"])
    assert partitions.read_partitions(spark, path).count() == 3


def test_a_stopped_replacement_is_finished_by_the_next_reader(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    schema = "k int, v string, p int"
    partitions.merge_partitions(spark.createDataFrame([(1, "a", 1), (2, "b", 2)], schema), path, ["k"], ["p"])
    with monkeypatch.context() as m:
        m.setattr(partitions, "_put_in", lambda *_: None)  # stopped just before
        partitions.merge_partitions(spark.createDataFrame([(1, "c", 1), (3, "d", 1)], schema), path, ["k"], ["p"])
    for f in files(f"{path}/p=1"):
        os.remove(f)  # or in its midst
    assert rows(partitions.read_partitions(spark, path)) == [(1, "c", 1), (2, "b", 2), (3, "d", 1)]
    os.makedirs(f"{path}.parts/p=9")  # a copy without its list counts for nothing
    assert partitions.read_partitions(spark, path).count() == 3


def test_entities_are_rebuilt_whole(spark, tmp_path):
    path = f"{tmp_path}/t"
    news = spark.createDataFrame([(p, d) for p in range(50) for d in range(p % 4)], "person int, day int")
    model = lambda df: lambda of: of(df).groupBy("person").agg(F.count("*").alias("n"), F.max("day").alias("last")).where("n > 1")
    everyone = news.select("person")
    partitions.rebuild_entities(path, "person", everyone, model(news), 8)
    before = files(path)
    later = news.where("person <> 3").unionByName(spark.createDataFrame([(7, 9), (70, 1), (70, 2)], "person int, day int"))
    partitions.rebuild_entities(path, "person", spark.createDataFrame([(3,), (7,), (70,), (None,)], "person int"), model(later), 8)
    assert rows(partitions.read_partitions(spark, path).drop("bucket")) == rows(model(later)(lambda df: df))
    assert len(set(before) & set(files(path))) >= 4


def counted(df, column, accumulator):
    """The rows, each added to the accumulator whenever it is computed."""

    def seen(_):
        accumulator.add(1)
        return True

    return df.where(F.udf(seen, "boolean").asNondeterministic()(column))


def test_changed_entities_are_found_once(spark, tmp_path):
    path, n = f"{tmp_path}/t", spark.sparkContext.accumulator(0)
    news = spark.createDataFrame([(p, d) for p in range(20) for d in range(3)], "person int, day int")
    model = lambda of: of(news).join(of(news.groupBy("person").agg(F.max("day").alias("last"))), "person")
    for _ in range(2):
        partitions.rebuild_entities(path, "person", counted(news, "person", n), model, 4)
    assert n.value == 2 * 60
    assert rows(partitions.read_partitions(spark, path).drop("bucket")) == rows(model(lambda df: df))
    assert not os.path.exists(f"{path}.changed")


def test_games_are_joined_once_for_both_builds(spark, tmp_path, monkeypatch):
    day = lambda n: dt.date(1997, 6, 1) + dt.timedelta(n)
    orders = [(i, i % 10, day(37 * i % 400)) for i in range(60)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate date").write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(i % 60, i % 7, day(31 * i % 420)) for i in range(150)]
    spark.createDataFrame(lines, "l_orderkey long, l_suppkey long, l_shipdate date").write.parquet(f"{tmp_path}/lineitem.parquet")
    n, games = spark.sparkContext.accumulator(0), storage_queries.S._appearances
    want = storage_queries.S._spans(spark, str(tmp_path)).drop("side", "injury_length", "currently_injured")
    names, want = want.columns, rows(want)
    monkeypatch.setattr(storage_queries.S, "_appearances", lambda *a: counted(games(*a), "person_id", n))
    out = storage_queries.spans_of_changed_people(spark, str(tmp_path))
    assert n.value == 150
    assert rows(out.select(*names)) == want and want


def test_backfill_equals_a_full_build(spark, tmp_path):
    rnd = random.Random(3)
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(n)
    events = spark.createDataFrame([(day(rnd.randrange(40)), rnd.choice("ab"), rnd.randrange(9)) for _ in range(900)], "d date, k string, v int")

    def model(df):
        daily = df.groupBy("d", "k").agg(F.sum("v").alias("v"))
        from pyspark.sql import Window

        three = Window.partitionBy("k").orderBy(F.unix_date("d")).rangeBetween(-3, 0)
        return daily.withColumn("rolling", F.sum("v").over(three))

    path = f"{tmp_path}/t"
    gone = [day(n) for n in (0, 7, 8, 20, 39)]
    landed = events.where(~F.col("d").isin(gone))
    partitions.replace_partitions(path, ["d"], landed.select("d"), lambda _: model(landed))
    before = files(path)
    partitions.backfill(path, "d", spark.createDataFrame([(d,) for d in gone], "d date").withColumnRenamed("d", "date"), events, model, 3)
    assert rows(partitions.read_partitions(spark, path).select("d", "k", "v", "rolling")) == rows(model(events))
    assert len(set(before) & set(files(path))) >= 15  # days out of reach keep their files


def test_an_incremental_model_keeps_its_history_after_a_stopped_write(spark, tmp_path):
    home = Warehouse(spark, str(tmp_path))
    home.add(Model("m", ("raw",), lambda raw: raw, "incremental", ("k",)))
    home.run(["m"], {"raw": spark.range(10).withColumnRenamed("id", "k")})
    path = home.path(home.models["m"])
    os.rename(path, f"{path}.last")  # between the two renames
    assert home.run(["m"], {"raw": spark.createDataFrame([(10,)], "k long")})["m"].count() == 11


@pytest.mark.parametrize("by", [(), ("p",)])
def test_a_model_that_is_not_as_expected_is_not_put_in_place(spark, tmp_path, by):
    expects = Expectations(not_null=["v"], accepted={"v": ["a", "b"]}, unique=["k"], apart=(["v"], "s", "e"))
    home = Warehouse(spark, str(tmp_path))
    home.add(Model("m", ("raw",), lambda raw: raw, "incremental", ("k",), by=by, expects=expects))
    home.add(Model("after", ("m",), lambda m: m, "table"))
    schema = "k int, v string, p int, s date, e date"
    d = dt.date
    home.run(["after"], {"raw": spark.createDataFrame([(1, "a", 1, d(2024, 1, 1), d(2024, 1, 5)), (2, "a", 1, d(2024, 1, 5), None)], schema)})
    bad = {
        "v is null': 1": [(3, None, 1, d(2020, 1, 1), d(2020, 1, 2))],
        "v is something else': 2": [(3, "c", 1, d(2020, 1, 1), d(2020, 1, 2)), (4, "c", 1, d(2021, 1, 1), d(2021, 1, 2))],
        "not unique": [(5, "b", 1, d(2020, 1, 1), d(2020, 1, 2)), (5, "b", 1, d(2021, 1, 1), d(2021, 1, 2))],
        "overlaps": [(6, "a", 1, d(2025, 1, 1), None)],
    }
    for message, new in bad.items():
        with pytest.raises(AssertionError, match=message):
            home.run(["after"], {"raw": spark.createDataFrame(new, schema)})
        assert spark.read.parquet(home.path(home.models["m"])).count() == 2 == spark.read.parquet(home.path(home.models["after"])).count()
    home.run(["after"], {"raw": spark.createDataFrame([(3, "b", 1, d(2020, 1, 1), None)], schema)})
    assert spark.read.parquet(home.path(home.models["after"])).count() == 3


def test_a_key_twice_in_a_batch_is_an_error(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    batch = spark.createDataFrame([(1, "b", 1), (1, "c", 2), (None, "d", 3), (None, "e", 4)], "k int, v string, n int")
    with pytest.raises(Exception, match="a key twice: 1"):
        tables.upsert_coalesce(target, batch, ["k"]).collect()
    latest = tables.latest_of_keys(batch, ["k"], [F.desc("n")])
    assert rows(tables.upsert_coalesce(target, latest, ["k"]).select("k", "v")) == [(1, "c")]


def test_a_late_older_row_never_wins(spark, tmp_path):
    ts = dt.datetime(2024, 1, 1)
    hour = dt.timedelta(hours=1)
    for n, batch in enumerate([[(1, ts, "a"), (2, ts, "x")], [(1, ts - hour, "old"), (2, ts + hour, "y"), (3, None, "z")], [(2, ts, "older"), (1, ts, "same"), (3, ts, "w")]]):
        spark.createDataFrame(batch, "k int, ts timestamp, v string").coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
        os.utime(f"{tmp_path}/in/{n}", (n, n))
    stream = spark.readStream.schema("k int, ts timestamp, v string").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
    q = lookback.merge_into(stream, f"{tmp_path}/t", ["k"], "ts", f"{tmp_path}/c").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert rows(spark.read.parquet(f"{tmp_path}/t").select("k", "v")) == [(1, "same"), (2, "y"), (3, "w")]


def test_the_wide_table_equals_plain_python(spark):
    rnd = random.Random(5)
    kinds, metrics, n = ("ff", "sl"), ("velo", "spin"), 3
    outings = []
    for p in range(4):
        for g in range(12):
            values = [rnd.choice([None, float(rnd.randrange(50))]) for _ in range(4)]
            outings.append((p, dt.date(2024, 4, 1) + dt.timedelta(g // 2 * 3 if p else g), g, rnd.randrange(100), rnd.random() < 0.5, *values))
    cols = ["p", "d", "g", "pitches", "role_switch", "ff_velo", "ff_spin", "sl_velo", "sl_spin"]
    df = spark.createDataFrame(outings, "p int, d date, g int, pitches int, role_switch boolean, ff_velo double, ff_spin double, sl_velo double, sl_spin double")
    out = {(r.p, r.g): r for r in wide.wide_history(df, "p", ["d", "g"], "pitches", kinds, metrics, n, facts=["g", "role_switch"]).collect()}
    near = lambda a, b: (a is None and b is None) or a == pytest.approx(b)
    for p in range(4):
        own = [dict(zip(cols, o, strict=True)) for o in outings if o[0] == p]
        for i, o in enumerate(own):
            for c in cols[3:]:
                if c != "role_switch":
                    before = own[i - 1][c] if i else None
                    o[f"{c}_delta"] = None if o[c] is None or before is None else o[c] - before
        for o in own:
            past = [x for x in own if x["d"] < o["d"]][::-1][:n]
            r = out[p, o["g"]]
            assert [r[f"has_outing_t_{i}"] for i in (1, 2, 3)] == [int(len(past) >= i) for i in (1, 2, 3)]
            assert r.role_switch_count == sum(x["role_switch"] for x in past[: n - 1])
            for c, name in (("pitches", "prior_pitches"), *((f"{k}_{m}",) * 2 for k in kinds for m in metrics)):
                pairs = [(i, x[c]) for i, x in enumerate(past, 1) if x[c] is not None]
                assert near(r[f"{name}_last3_mean"], statistics.mean(v for _, v in pairs) if pairs else None)
                assert near(r[f"{name}_last3_slope"], statistics.linear_regression(*zip(*pairs, strict=True)).slope if len(pairs) > 1 else None)
                deltas = [x[f"{c}_delta"] for x in past[: n - 1] if x[f"{c}_delta"] is not None]
                assert near(r[f"{name}_last3_avg_delta"], statistics.mean(deltas) if deltas else None)
            assert near(r.prior_pitches_last3_stddev, statistics.pstdev(x["pitches"] for x in past[: n - 1]) if past else None)
            told = json.loads(r.last3_outings_json)
            assert [t["rn"] for t in told] == list(range(1, len(past) + 1))
            for t, x in zip(told, past, strict=True):
                assert t["g"] == x["g"] and t["pitches"] == x["pitches"] and t.get("pitches_delta_prev") == x["pitches_delta"]
                assert all(t[k].get(m) == x[f"{k}_{m}"] and t[k].get(f"{m}_delta_prev") == x[f"{k}_{m}_delta"] for k in kinds for m in metrics)


def test_the_wide_table_is_planned_fast_with_one_shuffle(spark):
    width = ", ".join(f"CAST(id % {i + 3} AS DOUBLE) AS {c}" for i, c in enumerate(wide.series(wide_queries.KINDS, wide_queries.METRICS)))
    df = spark.range(100).selectExpr("id % 5 AS p", "date_add(DATE'2024-01-01', CAST(id AS INT)) AS d", "id AS g", "CAST(id AS INT) AS pitches", "id % 3 = 0 AS role_switch", *width.split(", ")).repartition(3)
    began = time.perf_counter()
    plan = wide.wide_history(df, "p", ["d", "g"], "pitches", wide_queries.KINDS, wide_queries.METRICS)._jdf.queryExecution().executedPlan().toString()
    assert time.perf_counter() - began < 20  # 3 s on a free machine
    assert plan.count("Exchange") == 1


def test_what_each_outing_tells_is_listed_in_place_of_its_json(spark):
    rows = [("a", dt.date(2024, 1, d), f"g{d}", d * 1.0, d, d % 2 == 0) for d in range(1, 7)]
    df = spark.createDataFrame(rows, "p string, d date, g string, ff_x double, pitches int, role_switch boolean")
    args = (df, "p", ["d", "g"], "pitches", ["ff"], ["x"], 3)
    whole = {r.g: json.loads(r.last3_outings_json) for r in wide.wide_history(*args, facts=["g"]).collect()}
    once = {r.g: r.last3_outings for r in wide.wide_history(*args, facts=["g"], each=lambda text: f"get_json_object({text}, '$.g')").collect()}
    assert once == {g: [x["g"] for x in listed] for g, listed in whole.items()} and once["g5"] == ["g4", "g3", "g2"]


def test_wide_rollups_are_of_the_last_outings_only_and_equal_in_small_batches(spark):
    values = [1.0, float("nan"), 3.0, float("inf"), 5.0, 6.0, None, 8.0, 9.0, 11.0]
    rows = [(p, dt.date(2024, 1, 1) + dt.timedelta(g // 2 if p else g), g, v, 1, False) for p in range(3) for g, v in enumerate(values)]
    df = spark.createDataFrame(rows, "p int, d date, g int, ff_x double, pitches int, role_switch boolean")
    told = []
    for batch in (10_000, 2):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        out = wide.wide_history(df, "p", ["d", "g"], "pitches", ["ff"], ["x"], 3, facts=["g"])
        told.append({(r.p, r.g): (r.ff_x_last3_mean, r.ff_x_last3_slope, r.ff_x_last3_avg_delta, r.last3_outings_json) for r in out.collect()})
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert str(told[0]) == str(told[1])  # a nan is no other nan's equal
    assert str(told[0][0, 4][0]) == "nan" and told[0][0, 5][0] == float("inf")  # what is not a number is in the mean of the outings after it
    assert told[0][0, 7][:3] == (5.5, -1.0, 1.0) and told[0][0, 9][:3] == (8.5, -1.0, 1.0)  # and in no later one's


def test_steps_make_what_an_outing_tells_one_after_the_other(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 1, d), d, d * 1.0, d, d % 2 == 0) for d in range(1, 5)], "p string, d date, g int, ff_x double, pitches int, role_switch boolean")
    steps = [lambda text: f"from_json({text}, 'g int, ff struct<x: double>')", lambda x: f"concat_ws(':', {x}.g, {x}.ff.x)"]
    out = wide.wide_history(df, "p", ["d", "g"], "pitches", ["ff"], ["x"], 2, facts=["g"], each=steps)
    assert {r.g: r.last2_outings for r in out.collect()} == {1: [], 2: ["1:1.0"], 3: ["2:2.0", "1:1.0"], 4: ["3:3.0", "2:2.0"]}


def test_an_outing_is_shuffled_by_its_person_once(spark):
    plan = wide_queries.outing_features_wide(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    wide_rows = [line for line in plan.split("\n") if "Exchange hashpartitioning(l_suppkey#" in line]
    assert len(wide_rows) == 3  # outings, and narrow ones of spans: by day, by supplier
