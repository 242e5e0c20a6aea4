"""Operators that must give whole results when one key holds most of the rows."""

import datetime as dt
import itertools
import random
import statistics

import pytest
from pyspark.sql import functions as F

from skyloom.operators import grid as G
from skyloom.operators import scale as S
from skyloom.operators import windows as W


def skewed(spark, n=3000):
    """A third of all rows under one key."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50)
    return spark.range(n).select("id", key.cast("int").alias("k"), ((F.col("id") * 7919) % 1009).cast("double").alias("value"))


def test_row_ordinals(spark):
    got = S.row_ordinals(skewed(spark), ["k", "value", "id"]).collect()
    order = sorted((r["k"], r["value"], r["id"]) for r in got)
    assert [order.index((r["k"], r["value"], r["id"])) for r in got] == [r["ordinal"] for r in got]


def test_running_offsets(spark):
    got = S.running_offsets(skewed(spark), ["id"], F.col("id") % 5, "before").orderBy("id").collect()
    want = list(itertools.accumulate((r["id"] % 5 for r in got), initial=0))[:-1]
    assert [r["before"] for r in got] == want


def test_group_ordinals(spark):
    got = S.group_ordinals(skewed(spark), ["k"], ["value", "id"]).collect()
    groups = {}
    for r in got:
        groups.setdefault(r["k"], []).append((r["value"], r["id"], r["ordinal"]))
    for rows in groups.values():
        assert [o for _, _, o in sorted(rows)] == list(range(len(rows)))


def test_salted_join(spark):
    big = skewed(spark)
    small = spark.createDataFrame([(k, f"n{k}") for k in range(0, 40)], "k int, name string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain = big.join(small, ["k"], how)
        salted = S.salted_join(big, small, ["k"], ["id"], how, 8).select(*plain.columns)
        assert plain.exceptAll(salted).isEmpty() and salted.exceptAll(plain).isEmpty()


def test_matching_pairs_against_brute_force(spark):
    rng = random.Random(1)
    make = lambda n: [(i, rng.randrange(2), sorted(rng.sample("abcdef", rng.randrange(1, 4)))) for i in range(n)]
    left, right = make(60), make(40)
    l = spark.createDataFrame(left, "i int, s int, lv array<string>")
    r = spark.createDataFrame(right, "j int, s int, rv array<string>")
    got = S.matching_pairs(l, r, ["s"], F.col("lv"), F.col("rv"), F.arrays_overlap("lv", "rv"), ["i"], 4)
    want = sorted((a[0], b[0]) for a in left for b in right if a[1] == b[1] and set(a[2]) & set(b[2]))
    assert sorted((x["i"], x["j"]) for x in got.collect()) == want


def test_interval_pairs_against_brute_force(spark):
    rng = random.Random(2)
    day = lambda: dt.date(2020, 1, 1) + dt.timedelta(days=rng.randrange(400))
    left = [(i, 1, *sorted((day(), day()))) for i in range(30)]
    right = [(i, 1, *sorted((day(), day()))) for i in range(30)]
    l = spark.createDataFrame(left, "i int, s int, a date, b date")
    r = spark.createDataFrame(right, "j int, s int, c date, e date")
    got = S.interval_pairs(l, r, ["s"], ("a", "b"), ("c", "e"), ["i"])
    want = sorted((x[0], y[0]) for x in left for y in right if x[2] <= y[3] and y[2] <= x[3])
    assert sorted((x["i"], x["j"]) for x in got.collect()) == want


def test_median_of_a_hot_group(spark):
    data = skewed(spark).withColumn("value", F.when(F.col("id") % 97 != 0, F.col("value")).otherwise(F.lit(float("nan"))))
    groups = {}
    for r in data.where("NOT isnan(value)").collect():
        groups.setdefault(r["k"], []).append(r["value"])
    want = {k: statistics.median(v) for k, v in groups.items()}
    assert {r["k"]: r["value"] for r in G.exact_median(data, ["k"], "value").collect()} == want


@pytest.mark.parametrize("seed", range(4))
def test_median_of_any_numbers(spark, seed):
    rng = random.Random(seed)
    draw = [lambda: rng.gauss(0, 1e-3), lambda: rng.choice([-1e300, 0.0, -0.0, 1e-320, 999.9999999999999, 1000.0]), lambda: rng.expovariate(1) ** 9, lambda: float(rng.randint(-3, 3))]
    rows = [(k, draw[seed]()) for k in range(3) for _ in range(rng.randint(1, 400))]
    want = {k: statistics.median([v for i, v in rows if i == k]) for k in range(3)}
    got = G.exact_median(spark.createDataFrame(rows, "k int, v double"), ["k"], "v")
    assert {r["k"]: r["v"] for r in got.collect()} == want


def test_median_of_mostly_zeros_spreads_evenly(spark):
    data = spark.range(200_000, numPartitions=8).select((F.col("id") % 2).alias("k"), F.when(F.rand(1) > 0.9, F.rand(2)).otherwise(0.0).alias("v"))
    counted = data.groupBy("k", "v").agg(F.count("v").alias("n"))
    sizes = [r["count"] for r in counted.repartition(8, "k", "v").groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 2 * sum(sizes) / 8
    assert {r["k"]: r["v"] for r in G.exact_median(data, ["k"], "v").collect()} == {0: 0.0, 1: 0.0}


def test_group_without_any_value_keeps_its_row(spark):
    data = spark.createDataFrame([(1, None), (2, 1.0), (2, 4.0)], "k int, value double")
    assert {r["k"]: r["value"] for r in G.exact_median(data, ["k"], "value").collect()} == {1: None, 2: 2.5}


def test_clumps_over_block_borders(spark):
    rng = random.Random(3)
    mask = [rng.random() < 0.8 for _ in range(500)]
    rows = spark.createDataFrame([(i, m) for i, m in enumerate(mask)], "p int, m boolean")
    got = sorted((r["start"], r["stop"]) for r in W.clumps(rows, [], "p", F.col("m"), block=16).collect())
    want, start = [], None
    for i, m in enumerate([*mask, False]):
        if m and start is None:
            start = i
        elif not m and start is not None:
            want.append((start, i))
            start = None
    assert got == want


def test_custom_reducer_over_many_partitions(spark):
    reducer = G.DecomposableReducer(
        ("total",),
        lambda s: {"total": float(s.sum())},
        lambda f: {"total": float(f["total"].sum())},
        lambda f: f["total"] * 2,
    )
    data = skewed(spark).repartition(7)
    got = {r["k"]: r["value"] for r in G.custom_reduce(data, reducer, ["k"]).collect()}
    want = {r["k"]: r["t"] * 2 for r in data.groupBy("k").agg(F.sum("value").alias("t")).collect()}
    assert got == want


def test_checkpoint_folder_of_the_session_is_used(spark):
    from skyloom.session import checkpointed

    checkpointed(spark.range(3))
    before = spark.sparkContext.getCheckpointDir()
    checkpointed(spark.range(3))
    assert spark.sparkContext.getCheckpointDir() == before


def test_limit_per_group_is_taken_before_the_shuffle(spark):
    from skyloom.operators.catalogue import first_features

    plan = first_features(skewed(spark), ["k"], "id", 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_one_large_cube_is_unfolded_over_the_cluster(spark, monkeypatch):
    from skyloom.operators import cubes as C

    values = lambda n: [f"{i:03d}" for i in range(n)]
    rows = [(1, values(30), values(20), values(10)), (2, ["a"], ["b"], ["c", "d"])]
    cubes = spark.createDataFrame(rows, "i int, a array<string>, b array<string>, c array<string>")
    want = {tuple(r) for r in C.unfold_with_ordinal(cubes, ["a", "b", "c"]).select("i", "a", "b", "c", "ordinal").collect()}
    monkeypatch.setattr(C, "PIECE", 100)
    fields = C.unfold_with_ordinal(cubes, ["a", "b", "c"])
    assert {tuple(r) for r in fields.select("i", "a", "b", "c", "ordinal").collect()} == want
    assert len(want) == 6002
    tasks = C.unfold(cubes.where("i = 1"), ["a", "b", "c"]).select(F.spark_partition_id()).distinct().count()
    assert tasks > 1


def test_unfolding_reads_its_input_once(spark, folder):
    from skyloom.operators import cubes as C

    cubes = spark.read.parquet(f"{folder}/events.parquet").select(F.array("event_type").alias("a"), F.array("user_id").alias("b"))
    plan = C.unfold(cubes, ["a", "b"])._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1


def test_cubes_too_large_to_count(spark):
    from skyloom.operators import cubes as C

    cubes = spark.range(1).select(*[F.sequence(F.lit(1), F.lit(100_000)).alias(k) for k in "abcd"])
    assert cubes.select(C.field_count(list("abcd")).alias("n")).first()["n"] is None
    with pytest.raises(Exception, match="too many fields"):
        C.unfold(cubes, list("abcd")).count()


def random_ranges(rng, n):
    """Days around 1970, so that blocks lie on both sides of day 0; some ranges are long, some are reversed, some lack an end."""
    rows = []
    for i in range(n):
        start = dt.date(1970, 1, 1) + dt.timedelta(days=rng.randrange(-12000, 12000))
        length = rng.choice([0, 1, 2, 30, 400, 9000, -3])
        rows.append((i, i % 2, start, start + dt.timedelta(days=length) if rng.random() > 0.03 else None))
    return rows


def test_ranges_of_all_lengths_meet_once(spark):
    rng = random.Random(17)
    left, right = random_ranges(rng, 150), random_ranges(rng, 120)
    lefts = spark.createDataFrame(left, "i int, k int, ls date, le date")
    rights = spark.createDataFrame(right, "j int, k int, rs date, re date")
    got = S.interval_pairs(lefts, rights, ["k"], ("ls", "le"), ("rs", "re"), ["i"]).select("i", "j").collect()
    whole = lambda r: r[3] is not None and r[2] <= r[3]
    want = {
        (a[0], b[0])
        for a in filter(whole, left)
        for b in filter(whole, right)
        if a[1] == b[1] and a[2] <= b[3] and b[2] <= a[3]
    }
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_ranges_are_written_once_in_blocks_and_meet_as_they_should(spark, monkeypatch):
    from pathlib import Path

    import pyarrow as pa

    from skyloom.operators import constraints as N
    from skyloom.operators import meetings as M
    from skyloom.session import scratch

    folders = []
    monkeypatch.setattr(M, "MOST_IN_BLOCK", 7)
    monkeypatch.setattr(M, "RUNS_AT_ONCE", 20, raising=False)
    monkeypatch.setattr(M, "BYTES_AT_ONCE", 2000, raising=False)
    monkeypatch.setattr(M, "scratch", lambda *at: folders.append(scratch(*at)) or folders[-1], raising=False)
    rng = random.Random(23)
    left, right = random_ranges(rng, 260), random_ranges(rng, 170)
    left = [(i, k if i % 19 else None, s, e, f"t{i}" if i % 3 else None, [i, None]) for i, k, s, e in [*left, *left[:9]]]  # some rows stand twice
    left += [(900 + i, 0, dt.date(1940, 1, 1), dt.date(2026, 1, 1), None, None) for i in range(40)]
    right = [(j, k if j % 23 else None, s, e) for j, k, s, e in right]
    requests = spark.createDataFrame(left, "request_id int, dataset int, start date, end date, note string, more array<int>")
    allowed = spark.createDataFrame(right, "constraint_id int, dataset int, d_start date, d_end date")
    got = N.intersect_date_ranges(requests, allowed)
    assert got.columns == ["dataset", "request_id", "start", "end", "note", "more", "constraint_id"]
    whole = lambda r: r[1] is not None and r[3] is not None and r[2] <= r[3]
    lefts, rights = list(filter(whole, left)), list(filter(whole, right))
    want = [
        (a[1], a[0], max(a[2], b[2]), min(a[3], b[3]), a[4], a[5], b[0])
        for a in lefts
        for b in rights
        if a[1] == b[1] and a[2] <= b[3] and b[2] <= a[3]
    ]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want)) and len(want) > 4000
    assert N.intersect_date_ranges(requests.where("false"), allowed).count() == 0
    assert N.intersect_date_ranges(requests, allowed.where("false")).count() == 0
    files = [f for f in Path(folders[0].removeprefix("file:")).rglob("*.arrow")] if folders else []
    assert sum(pa.ipc.open_file(str(f)).read_all().num_rows for f in files) == len(lefts) + len(rights)  # not once for each block of days


def test_long_range_has_few_nodes_and_all_meetings_are_pairs(spark):
    days = spark.sql("SELECT date'0001-01-01' AS s, date'9999-12-31' AS e UNION ALL SELECT date'1940-01-02', date'2026-07-30'")
    for asks in (True, False):
        sizes = [r["n"] for r in days.select(F.size(S.range_nodes(F.col("s"), F.col("e"), asks)).alias("n")).collect()]
        assert max(sizes) <= 3 * S.NODE_LEVELS
    plan = S.interval_pairs(
        days, days.toDF("rs", "re"), [], ("s", "e"), ("rs", "re"), ["s"]
    )
    assert plan.count() == 4


def test_constraints_with_ranges_of_centuries(spark):
    from skyloom.operators import constraints as N

    asked = [(1, "d", ["1850-01-01/2100-12-31"]), (2, "d", ["1999-05-01/1999-05-01", "1800-01-01/1800-02-01"]), (3, "d", ["1700-01-01/1700-01-02"])]
    requests = spark.createDataFrame(asked, "request_id int, dataset string, d array<string>")
    allowed = spark.createDataFrame([(7, "d", ["1800-01-15/1999-12-31"])], "constraint_id int, dataset string, d array<string>")
    got = {r["request_id"]: r["d"] for r in N.intersect(requests, allowed, ["d"], ranges=["d"]).collect()}
    assert got == {1: ["1850-01-01/1999-12-31"], 2: ["1999-05-01/1999-05-01", "1800-01-15/1800-02-01"]}


def test_nearest_on_a_fine_axis_joins_nothing(spark):
    import numpy as np

    axis = np.round(np.arange(-18000, 18000) / 100, 2)
    rng = np.random.default_rng(5)
    asked = np.concatenate([np.full(1500, 12.3449), rng.uniform(-200, 200, 3000), axis[:300], [np.inf, -np.inf]])
    cells = spark.createDataFrame([(float(x),) for x in axis], "longitude double").repartition(5)
    points = spark.createDataFrame([(i, float(x)) for i, x in enumerate(asked)], "i int, longitude double").repartition(6)
    located = G.nearest_points(cells, points, "longitude", "near")
    got = np.array([r["near"] for r in located.orderBy("i").collect()])
    at = np.searchsorted((axis[1:] + axis[:-1]) / 2, asked, side="right")
    assert (got == axis[at]).all()
    assert "Join" not in located._jdf.queryExecution().optimizedPlan().toString()


def test_nearest_of_points_without_a_place_and_of_one_coordinate(spark):
    cells = spark.createDataFrame([(4.0,), (None,), (float("nan"),)], "latitude double")
    points = spark.createDataFrame([(1, None), (2, float("nan")), (3, -80.0), (4, 4.0), (5, 90.0)], "i int, latitude double")
    got = {r["i"]: r["near"] for r in G.nearest_points(cells, points, "latitude", "near").collect()}
    assert got == {1: None, 2: None, 3: 4.0, 4: 4.0, 5: 4.0}


def test_facets_with_the_first_open_meet_only_what_agrees(spark):
    from skyloom.operators import catalogue as K

    rng = random.Random(23)
    pick = lambda values: rng.choice(values)
    stock = [(i, pick("abc"), pick("xyz"), pick(["v1", "v2", None])) for i in range(400)]
    asked = [(i, pick([None, None, "a"]), pick([None, "x", "y"]), pick(["v1", None]), pick([None, "1"])) for i in range(200)]
    asked += [(1000 + i, None, "x", "v1", None) for i in range(100)]
    candidates = spark.createDataFrame(stock, "c int, first string, second string, third string").withColumn("name", F.concat("first", F.col("c") % 10))
    requests = spark.createDataFrame(asked, "r int, first string, second string, third string, name string")
    keys = ["first", "second", "third"]
    got = [tuple(p) for p in K.facet_candidates(requests, candidates, keys, {}, {"name": "{name}$"}).select("r", "c").collect()]
    agrees = lambda a, b: all(x is None or x == y for x, y in zip(a[1:4], b[1:4]))
    want = {(a[0], b[0]) for a in asked for b in stock if agrees(a, b) and (a[4] is None or b[0] % 10 == 1)}
    assert len(got) == len(want) and set(got) == want
    met = K.facet_meetings(requests.where("first IS NULL").select("r", *keys), candidates, keys)
    open_first = [a for a in asked if a[1] is None]
    assert met.count() == sum(agrees(a, b) for a in open_first for b in stock)


def test_facets_summed_up_for_each_selection(spark):
    from skyloom.operators import catalogue as K

    candidates = spark.range(60).selectExpr("id AS c", "concat('v', id % 3) AS first")
    asked = spark.range(500).selectExpr("id AS r", "IF(id % 2 = 0, 'v1', NULL) AS first")
    measures = [F.count(F.lit(1)).alias("n"), F.min("c").alias("least")]
    found = K.facet_candidates(asked, candidates, ["first"], {}, summary=measures)
    assert found.columns == ["r", "first", "n", "least"]
    assert {tuple(x) for x in found.collect()} == {(i, None, 60, 0) if i % 2 else (i, "v1", 20, 1) for i in range(500)}


def test_facets_of_no_requests_or_candidates(spark):
    from skyloom.operators import catalogue as K

    some = spark.createDataFrame([(1, "a")], "c int, first string")
    asked = spark.createDataFrame([(1, None), (2, "a")], "r int, first string")
    assert K.facet_candidates(asked.limit(0), some, ["first"], {}).count() == 0
    assert K.facet_candidates(asked, some.limit(0), ["first"], {}).count() == 0
    assert K.facet_candidates(asked, some, ["first"], {}).count() == 2


def joined_by(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "broadcast" if "BroadcastHashJoin" in plan else "shuffle"


def with_broadcasts_below(spark, size, check):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, str(size))
    try:
        check()
    finally:
        spark.conf.set(name, before)


def test_copies_of_a_small_side_are_not_broadcast(spark):
    big, small = spark.range(5000).selectExpr("id", "id % 100 AS k"), spark.range(100).selectExpr("id AS k", "id * 2 AS v")

    def check():  # 1,600 bytes before the copies
        got = S.salted_join(big, small, ["k"], ["id"], salts=8)
        assert joined_by(got) == "shuffle"
        assert got.selectExpr("count(*)", "sum(v)").first() == (5000, 495000)
        assert joined_by(S.salted_join(big, small.limit(1), ["k"], ["id"], salts=2)) == "broadcast"

    with_broadcasts_below(spark, 20000, check)


def test_ranges_laid_out_are_not_broadcast(spark):
    asked = spark.range(200).selectExpr("id", "0 AS k", "date_add(DATE '2000-01-01', int(id)) AS s", "date_add(DATE '2000-03-01', int(id)) AS e")
    allowed = spark.range(100).selectExpr("id AS c", "0 AS k", "date_add(DATE '2000-01-01', int(id)) AS ds", "date_add(DATE '2002-01-01', int(id)) AS de")

    def check():  # 2,400 bytes before they are laid out
        got = S.interval_pairs(asked, allowed, ["k"], ("s", "e"), ("ds", "de"), ["id"], 2)
        assert joined_by(got) == "shuffle"
        assert got.count() == 19220  # the 780 other pairs lie apart

    with_broadcasts_below(spark, 100000, check)


def test_ranges_are_laid_out_no_wider_than_the_other_side_needs(spark):
    asked = spark.range(50).selectExpr("id", "0 AS k", "date_add(DATE '2000-01-01', int(id)) AS s", "date_add(DATE '2000-01-01', int(id)) AS e")
    allowed = spark.range(50).selectExpr("id AS c", "0 AS k", "date_add(DATE '2000-01-01', int(id)) AS ds", "date_add(DATE '2000-01-03', int(id)) AS de")
    got = S.interval_pairs(asked, allowed, ["k"], ("s", "e"), ("ds", "de"), ["id"], 2)
    assert {(r["id"], r["c"]) for r in got.collect()} == {(i, c) for i in range(50) for c in range(50) if 0 <= i - c <= 2}
    around = S.range_nodes(F.col("s"), F.col("e"), True, 2)
    assert asked.select(F.size(around).alias("n")).agg(F.max("n")).first()[0] == 2
    assert "sequence(0, 1" in got._jdf.queryExecution().analyzed().toString()
