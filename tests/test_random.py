"""Random inputs against the plain definition of an operator."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from skyloom.operators import catalogue as K
from skyloom.operators import constraints as N
from skyloom.operators import cubes as C
from skyloom.operators import forms
from skyloom.operators import grid as G
from skyloom.operators import meetings

BOX = "north double, west double, south double, east double"


def random_boxes(rng, n, size):
    for i in range(n):
        south, west = rng.uniform(-80, 70), rng.uniform(-170, 150)
        yield i, south + rng.uniform(0, size), west, south, west + rng.uniform(0, size)


@pytest.mark.parametrize("cell", [2.0, 10.0, 45.0])
def test_boxes_and_points(spark, cell):
    rng = random.Random(cell)
    boxes = list(random_boxes(rng, 40, 30))
    points = [(i, str(rng.uniform(-80, 80)), str(rng.uniform(-170, 170)), f"p{i}") for i in range(60)]
    areas = spark.createDataFrame(boxes, f"request_id int, {BOX}")
    sites = spark.createDataFrame(points, "place int, latitude string, longitude string, tag string")
    got = {(r["request_id"], r["place"]) for r in K.points_strictly_inside(areas, sites, cell).collect()}
    want = {
        (b[0], p[0])
        for b, p in itertools.product(boxes, points)
        if b[3] < float(p[1]) < b[1] and b[2] < float(p[2]) < b[4]
    }
    assert got == want


@pytest.mark.parametrize("cell", [3.0, 10.0])
def test_boxes_and_boxes(spark, cell):
    rng = random.Random(7)
    boxes, features = list(random_boxes(rng, 40, 25)), list(random_boxes(rng, 40, 12))
    areas = spark.createDataFrame(boxes, f"request_id int, {BOX}")
    shapes = spark.createDataFrame(features, f"feature int, {BOX}")
    got = [(r["request_id"], r["feature"]) for r in K.overlapping_features(areas, shapes, cell).collect()]
    want = {
        (a[0], b[0])
        for a, b in itertools.product(boxes, features)
        if b[3] <= a[1] and b[1] >= a[3] and b[2] <= a[4] and b[4] >= a[2]
    }
    assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("most", [3, 4096])
def test_boxes_in_blocks(spark, monkeypatch, most):
    monkeypatch.setattr(meetings, "MOST_IN_BLOCK", most)
    rng = random.Random(9)
    boxes, features = list(random_boxes(rng, 60, 25)), list(random_boxes(rng, 50, 12))
    areas = spark.createDataFrame([*boxes, (99, None, 0.0, 0.0, 1.0)], f"request_id int, {BOX}")
    shapes = spark.createDataFrame(features, f"feature int, {BOX}")
    want = {}
    for a, b in itertools.product(boxes, features):
        if b[3] <= a[1] and b[1] >= a[3] and b[2] <= a[4] and b[4] >= a[2]:
            want.setdefault(a[0], []).append(b[0])
    pairs = K.overlapping_features(areas, shapes, columns=["request_id", "feature"])
    assert pairs.columns == ["request_id", "feature"]
    assert sorted(map(tuple, pairs.collect())) == sorted((a, b) for a, found in want.items() for b in found)
    numbers = K.overlapping_features(areas, shapes, columns=["request_id"], counted="n")
    assert {r[0]: r[1] for r in numbers.groupBy("request_id").sum("n").collect()} == {a: len(f) for a, f in want.items()}
    some = K.overlapping_features(areas, shapes, columns=["request_id", "feature"], at_most=("feature", 2))
    first = K.first_features(some, ["request_id"], "feature", 2).collect()
    assert sorted(map(tuple, first)) == sorted((a, b) for a, found in want.items() for b in sorted(found)[:2])


def test_nearest_on_an_irregular_axis(spark):
    rng = random.Random(11)
    axis = sorted({round(rng.uniform(-90, 90), 1) for _ in range(25)})
    asked = [round(rng.uniform(-100, 100), 2) for _ in range(200)] + [(a + b) / 2 for a, b in zip(axis, axis[1:])]
    cells = spark.createDataFrame([(x,) for x in axis for _ in range(3)], "latitude double")
    points = spark.createDataFrame(list(enumerate(asked)), "i int, latitude double")
    got = {r["i"]: r["near"] for r in G.nearest_points(cells, points, "latitude", "near").collect()}
    for i, x in enumerate(asked):
        best = min(abs(a - x) for a in axis)
        assert abs(abs(got[i] - x) - best) < 1e-9
        if i >= 200:  # a midpoint belongs to the larger coordinate
            assert got[i] == axis[i - 200 + 1]


def random_fields(rng, n):
    return {(rng.choice("abc"), rng.choice("xy"), dt.date(2020, 1, rng.randrange(1, 9))) for _ in range(n)}


def test_field_sets(spark):
    rng = random.Random(13)
    keys, schema = ["p", "t", "d"], "p string, t string, d date"
    left, right = random_fields(rng, 40), random_fields(rng, 40)
    l, r = spark.createDataFrame(list(left), schema), spark.createDataFrame(list(right), schema)
    sides = {tuple(x)[:3]: x["side"] for x in C.compare(l, r, keys).collect()}
    assert {f for f, s in sides.items() if s == "both"} == left & right
    assert {f for f, s in sides.items() if s == "left"} == left - right
    rest = C.difference(l, r, keys)
    assert {tuple(x) for x in rest.select(*keys).collect()} == left - right
    # what is left and what is common give the whole again
    again = rest.select(*keys).unionByName(l.join(r, keys, "left_semi").select(*keys))
    assert C.same_fields(l, again, keys).first()["same"] is True
    assert C.same_fields(l, r, keys).first()["same"] is (left == right)
    merged = C.unfold(C.merge(l, keys), keys)
    assert {tuple(x) for x in merged.select(*keys).collect()} == left
    state = K.delivered_or_missing(l, r, keys).groupBy("state").count().collect()
    counts = {x["state"]: x["count"] for x in state}
    assert counts["delivered"] + counts["missing"] == len(left)


def test_unfolded_open_keyed_requests(spark):
    rng = random.Random(17)
    requests = []
    for i in range(30):
        names = rng.sample("abcd", rng.randrange(1, 5))
        requests.append((i, {k: sorted(rng.sample("uvwxyz", rng.randrange(1, 4))) for k in names}))
    df = spark.createDataFrame(requests, "i int, keys map<string,array<string>>")
    got = sorted((r["i"], r["f"]) for r in C.unfold_open(df).select("i", C.field_text(F.col("field")).alias("f")).collect())
    want = sorted(
        (i, ";".join(f"{k}={v}" for k, v in zip(sorted(keys), combination)))
        for i, keys in requests
        for combination in itertools.product(*[keys[k] for k in sorted(keys)])
    )
    assert got == want


def test_intersection_of_random_requests(spark):
    rng = random.Random(19)
    keys, texts = ["a", "b", "c"], "array<string>"

    def row(i, id_name):
        return (i, rng.randrange(2), *[sorted(rng.sample("uvwxyz", rng.randrange(1, 4))) if rng.random() < 0.7 else None for _ in keys])

    asked, allowed = [row(i, "r") for i in range(40)], [row(i, "c") for i in range(30)]
    columns = ", ".join(f"{k} {texts}" for k in keys)
    requests = spark.createDataFrame(asked, f"request_id int, dataset int, {columns}")
    rules = spark.createDataFrame(allowed, f"constraint_id int, dataset int, {columns}")
    got = {
        (r["request_id"], r["constraint_id"]): tuple(r[k] for k in keys) for r in N.intersect(requests, rules, keys).collect()
    }
    want = {}
    for a, c in itertools.product(asked, allowed):
        if a[1] != c[1] or all(v is None for v in a[2:]):
            continue
        cut = [None if y is None else [v for v in x or [] if v in y] for x, y in zip(a[2:], c[2:])]
        if all(y is None or v for v, y in zip(cut, c[2:])):
            want[(a[0], c[0])] = tuple(cut)
    assert got == want


def test_mixed_form_state_of_random_selections(spark):
    """A value is open when every other selected key agrees with its constraint or is absent from it."""
    rng = random.Random(23)
    keys, texts = ["a", "b", "c"], "array<string>"

    def row(i):
        return (i, rng.randrange(2), *[sorted(rng.sample("uvwxyz", rng.randrange(1, 4))) if rng.random() < 0.6 else None for _ in keys])

    asked, allowed = [row(i) for i in range(40)], [row(i) for i in range(25)]
    columns = ", ".join(f"{k} {texts}" for k in keys)
    selections = spark.createDataFrame(asked, f"request_id int, dataset int, {columns}")
    rules = spark.createDataFrame(allowed, f"constraint_id int, dataset int, {columns}")
    form = N.form_of_constraints(rules, keys)
    got = {(r["request_id"], r["key"], r["value"]) for r in forms.form_state_mixed(selections, rules, keys, form).collect()}
    want = set()
    for i, dataset, *values in asked:
        chosen = [k for k, v in zip(keys, values) if v is not None]
        for at, key in enumerate(keys):
            for _, other, *rule in allowed:
                if other != dataset or rule[at] is None:
                    continue
                alone = not chosen or chosen == [key]
                agrees = all(
                    v is None or rule[j] is None or set(v) & set(rule[j]) for j, v in enumerate(values) if j != at
                )
                if alone or agrees:
                    want |= {(i, key, v) for v in rule[at]}
    assert got == want


@pytest.mark.parametrize("most", [3, 4096])
def test_numbers_of_observations_in_blocks(spark, monkeypatch, most):
    from skyloom.operators import bulk

    monkeypatch.setattr(meetings, "MOST_IN_BLOCK", most)
    monkeypatch.setattr(meetings, "AT_ONCE", 40)
    rng = random.Random(13)
    at = lambda: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.randrange(6 * 1440))
    names = ["click", "view"]
    asked = [(i // 2 if i < 6 else i, *b[1:], *sorted((at(), at())), rng.choice([names, names[:1], ["view", "view"]])) for i, *b in ((b[0], *b) for b in random_boxes(rng, 30, 60))]
    seen = [(rng.randrange(1000) if i % 9 else None, at(), rng.choice([*names, "error"]), rng.uniform(-80, 80), rng.uniform(-170, 170) if i % 11 else None) for i in range(1500)]
    requests = spark.createDataFrame(asked, f"request_id int, {BOX}, start timestamp_ntz, end timestamp_ntz, variables array<string>")
    observations = spark.createDataFrame(seen, "id int, report_timestamp timestamp_ntz, observed_variable string, latitude double, longitude double")
    found = {}
    for i, n, w, s, e, start, end, variables in asked:
        for o in seen:
            if o[2] in variables and start <= o[1] < end and s <= o[3] < n and o[4] is not None and w <= o[4] < e:
                found.setdefault((i, o[2]), []).append(o[0])
    want = sorted((*k, len(v), min((x for x in v if x is not None), default=None)) for k, v in found.items())
    got = bulk.answer_from_observations(observations, requests, numbers_of="id")
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 20
    plain = bulk.answer_from_observations(observations, requests).groupBy("request_id", "variable").agg(F.count("*"), F.min("id"))
    assert sorted(tuple(r) for r in plain.collect()) == want
