import random

import pytest
from pyspark.sql import functions as F

from skyloom.functions import space as S
from skyloom.operators import catalogue as K
from skyloom.operators import grid as G

TENTH = S.RegularGrid(0.1, 0.1)
GRIDS = [TENTH, S.RegularGrid(delta_lat=0.3, delta_lon=0.7, lat0=0.05, lon0=0.2), S.RegularGrid(delta_lat=2.0, delta_lon=1.5)]


@pytest.mark.parametrize("grid", GRIDS)
def test_snapped_boxes_are_the_largest_on_the_grid_inside(spark, grid):
    rng = random.Random(31)
    boxes = []
    for _ in range(150):
        south, west = rng.uniform(-80, 70), rng.uniform(-170, 150)
        boxes.append((south + rng.uniform(3, 9), west, south, west + rng.uniform(3, 20)))
    df = spark.createDataFrame(boxes, "n double, w double, s double, e double")
    snapped = S.snap_inwards(*[F.col(c) for c in "nwse"], grid)
    rows = df.select("*", *[snapped[k].alias(k) for k in ("north", "west", "south", "east", "has_points")]).collect()
    for r in rows:
        assert r.has_points and r.s <= r.south + 1e-9 and r.north <= r.n + 1e-9 and r.w <= r.west + 1e-9 and r.east <= r.e + 1e-9
        for edge, first, step in ((r.north, grid.lat0, grid.delta_lat), (r.south, grid.lat0, grid.delta_lat), (r.west, grid.lon0, grid.delta_lon), (r.east, grid.lon0, grid.delta_lon)):
            steps = (edge - first) / step
            assert abs(steps - round(steps)) < 1e-6
        assert r.n - r.north < grid.delta_lat and r.south - r.s < grid.delta_lat
        assert r.west - r.w < grid.delta_lon and r.e - r.east < grid.delta_lon


def test_boxes_on_the_grid_stay(spark):
    df = spark.createDataFrame([(7.3, -4.2, 1.9, 12.0)], "n double, w double, s double, e double")
    snapped = S.snap_inwards(*[F.col(c) for c in "nwse"], TENTH)
    assert tuple(df.select(*[snapped[k] for k in ("north", "west", "south", "east")]).first()) == (7.3, -4.2, 1.9, 12.0)


def test_box_between_grid_points(spark):
    df = spark.createDataFrame([(1.01, 2.01, 1.01, 2.01)], "n double, w double, s double, e double")
    assert df.select(S.snap_inwards(*[F.col(c) for c in "nwse"], TENTH)["has_points"]).first()[0] is False


def test_grid_spacing_must_be_positive():
    with pytest.raises(ValueError):
        S.RegularGrid(0.0, 1.0)


def test_regional_cells(spark):
    grid = S.RegionalGrid(north=72.0, west=-25.0, south=30.0, east=45.0, dlat=0.1, dlon=0.1)
    boxes = [(50.02, 0.0, 40.0, 10.0), (None, None, None, None), (40.0, 0.0, 50.0, 10.0), (50.0, 0.0, 49.99, 10.0), (80.0, 0.0, 40.0, 10.0)]
    df = spark.createDataFrame(boxes, "n double, w double, s double, e double")
    snapped = S.snap_to_cells(*[F.col(c) for c in "nwse"], grid)
    got = [tuple(r) for r in df.select(*[snapped[k] for k in ("north", "west", "south", "east", "problem", "is_full")]).collect()]
    assert got[0] == (49.95, 0.05, 40.05, 9.95, None, False)
    assert got[1] == (71.95, -24.95, 30.05, 44.95, None, True)
    assert got[2][4].startswith("area north limit")
    assert got[3][4] == "requested area does not contain a grid point"
    assert got[4][4] == "north outside the grid"


AXIS = G.Axis(first=30.0, last=330.0, step=60.0, n_steps=1)
GLOBE = G.Axis(first=0.5, last=359.5, step=1.0, n_steps=1)
EUROPE = G.Axis(first=-59.5, last=-20.5, step=1.0, n_steps=1)


@pytest.mark.parametrize(
    "axis, west, east, want",
    [
        (GLOBE, 20, 40, [(20, 40)]),
        (GLOBE, -40, -20, [(320, 340)]),
        (GLOBE, 420, 440, [(60, 80)]),
        (GLOBE, -10, 30, [(350, 360.0), (0.0, 30)]),
        (AXIS, -180, 500, [(-180, 500)]),
        (EUROPE, -80, -40, [(-80, -40)]),
        (EUROPE, 280, 320, [(-80, -40)]),
    ],
)
def test_longitude_wrap(spark, axis, west, east, want):
    assert G.longitude_parts(west, east, axis) == want
    df = spark.createDataFrame([(float(west), float(east))], "w double, e double")
    parts = df.select(G.longitude_part_columns(F.col("w"), F.col("e"), axis)).first()[0]
    assert [(p["start"], p["end"]) for p in parts] == want


def test_parts_hold_the_cells_of_the_box(spark):
    boxes = [(w, w + width) for w in range(-355, 356, 35) for width in (3, 50, 200, 340)]
    df = spark.createDataFrame([(float(w), float(e)) for w, e in boxes], "w double, e double")
    for axis in (GLOBE, G.Axis(first=-179.5, last=179.5, step=1.0, n_steps=1), EUROPE):
        cells = [axis.first + i for i in range(int(axis.last - axis.first) + 1)]
        for r in df.select("w", "e", G.longitude_part_columns(F.col("w"), F.col("e"), axis).alias("parts")).collect():
            want = {x for x in cells for turn in (-360, 0, 360) if r.w <= x + turn <= r.e}
            assert {x for x in cells for p in r.parts or [] if p.start <= x <= p.end} == want
            if want:
                places = [next(i for i, p in enumerate(r.parts) if p.start <= x <= p.end) for x in sorted(want)]
                assert len(r.parts) <= 2 and set(places) <= {0, 1}


def test_longitudes_outside_the_axis(spark):
    from skyloom.errors import InvalidRequest

    with pytest.raises(InvalidRequest):
        G.longitude_parts(400.0, 420.0, G.Axis(-59.5, -20.5, 1.0, 1))


def test_microdegrees(spark):
    df = spark.createDataFrame([(10.0005, 1234500), (-0.0000005, 1235500)], "x double, m long")
    got = df.select(S.microdegrees(F.col("x")), S.snap_to_millidegrees(F.col("m"))).collect()
    assert [tuple(r) for r in got] == [(10000500, 1234000), (0, 1236000)]
    shifted = df.select(S.shift_microdegrees(F.lit(190000000)), S.shift_microdegrees(F.lit(-190000000))).first()
    assert tuple(shifted) == (-170000000, 170000000)


def test_nearest_tie_goes_to_the_larger_coordinate(spark):
    grid = spark.createDataFrame([(float(x),) for x in range(-90, 91, 20)], "latitude double")
    points = spark.createDataFrame([(0.0,), (-200.0,), (89.0,), (81.0,), (-9.9,)], "latitude double")
    got = {r["latitude"]: r["near"] for r in G.nearest_points(grid, points, "latitude", "near").collect()}
    assert got == {0.0: 10.0, -200.0: -90.0, 89.0: 90.0, 81.0: 90.0, -9.9: -10.0}


def test_points_strictly_inside(spark):
    areas = spark.createDataFrame([(1, 60.0, -10.0, 50.0, 10.0)], "request_id int, north double, west double, south double, east double")
    points = spark.createDataFrame(
        [(0, "55", "0", "UK"), (1, "52", "5", "NL"), (2, "60", "0", "edge"), (3, None, "0", "bad"), (4, "x", "0", "bad")],
        "place int, latitude string, longitude string, tag string",
    )
    assert K.map_areas_to_values(areas, points, "tag", "place").first()["values"] == ["UK", "NL"]


def test_box_around_point(spark):
    box = S.box_around(F.lit(1.0), F.lit(2.0), 2.0)
    row = spark.range(1).select(*[box[k] for k in ("west", "south", "east", "north")]).first()
    assert tuple(row) == (1.0, 0.0, 3.0, 2.0)


def test_select_area_errors(spark):
    from skyloom.errors import InvalidRequest

    cells = [(float(y), float(x), 1.0) for y in range(-75, 76, 30) for x in range(30, 331, 60)]
    grid = spark.createDataFrame(cells, "latitude double, longitude double, value double")
    with pytest.raises(InvalidRequest):
        G.select_area(grid, -40.0, 100.0, -44.0, 140.0)
    irregular = grid.unionByName(spark.createDataFrame([(80.0, 30.0, 1.0)], grid.schema))
    with pytest.raises(InvalidRequest):
        G.select_area(irregular, 50.0, 0.0, -50.0, 100.0)
    assert G.select_area(grid, 90.0, -30.0, -90.0, 30.0).where("part = 1").select("longitude").distinct().count() == 1


def test_preinterpolation_reads_the_numbers_of_an_area_once(spark):
    from skyloom.operators import requests as R

    raw = spark.range(2).select("id", F.create_map(F.lit("Area"), F.array(*[F.lit(x) for x in ("10.1", "0.1", "1.1", "9.1")])).alias("keys"))
    ready = R.simulate_preinterpolation(raw, S.RegularGrid(delta_lat=0.5, delta_lon=0.5)).where("problem IS NULL")
    assert ready.columns == ["id", "keys", "problem"]
    assert ready.first()["keys"] == {"Area": ["10.0", "0.5", "1.5", "9.0"], "grid": ["0.5", "0.5"]}
    # the text of a number is looked at in three ways
    assert ready._jdf.queryExecution().optimizedPlan().toString().upper().count("RLIKE") <= 3


def test_lists_of_boxes_of_any_size_from_few_or_many_points(spark):
    import random

    rng = random.Random(11)
    edge = "north double, west double, south double, east double"
    boxes = []
    for i in range(60):
        south, west = rng.uniform(-80, 70), rng.uniform(-170, 150)
        boxes.append((i // 2 if i < 6 else i, south + rng.choice([0.5, 9, 40, 1200]), west, south, west + rng.choice([1.0, 20, 300])))
    points = [(rng.randrange(50) if i % 5 else None, rng.uniform(-80, 80), rng.uniform(-170, 170), f"p{i}" if i % 7 else None) for i in range(90)]
    areas = spark.createDataFrame(boxes, f"request_id int, {edge}")
    sites = spark.createDataFrame(points, "place int, latitude double, longitude double, tag string")
    key = lambda p: (p[0] is not None, p[0] or 0, p[3] is not None, p[3] or "")
    want = {}
    for i, n, w, s, e in boxes:
        want.setdefault(i, []).extend(p for p in points if s < p[1] < n and w < p[2] < e)
    want = {i: [p[3] for p in sorted(found, key=key)] for i, found in want.items() if found}
    for most in (K.MOST_AT_HOME, 5):
        got = K.map_areas_to_values(areas, sites, "tag", "place", most).collect()
        assert len(got) == len(want) and {r["request_id"]: r["values"] for r in got} == want


def test_pairs_are_listed_only_for_crowded_homes_and_requests_of_several_boxes(spark, monkeypatch):
    ids = F.when(F.col("id") < 2, 0).otherwise(F.col("id")).cast("int").alias("request_id")
    areas = spark.range(300).select(ids, *[F.lit(x).alias(n) for n, x in (("north", 9.0), ("west", 0.0), ("south", 0.0), ("east", 9.0))])
    sites = spark.range(200).select(F.col("id").alias("place"), F.lit(1.0).alias("latitude"), F.lit(1.0).alias("longitude"), F.col("id").cast("string").alias("tag"))
    paired, real = [], K.points_strictly_inside
    monkeypatch.setattr(K, "points_strictly_inside", lambda a, p, **k: paired.append(a.count()) or real(a, p, **k))
    for most, pairs in ((K.MOST_AT_HOME, 2), (100, 300)):
        found = {r["request_id"]: r["values"] for r in K.map_areas_to_values(areas, sites, "tag", "place", most).collect()}
        assert len(found) == 299 and all(len(v) == (400 if i == 0 else 200) for i, v in found.items())
        assert found[7] == [str(i) for i in range(200)] and paired.pop() == pairs
