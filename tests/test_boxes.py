"""Set algebra on cubes against sets of fields, and the number of cubes it makes."""

import random
import time
from itertools import product

import pytest
from pyspark.sql import functions as F

from skyloom.operators import boxes as B
from skyloom.operators import costs as P
from skyloom.operators import cubes as C

KEYS = ["level", "param", "step"]
DOMAIN = {"level": ["100", "500", "850"], "param": ["q", "t", "u", "v"], "step": ["0", "6", "12", "18"]}
SCHEMA = "owner int, cube_id int, level array<string>, param array<string>, step array<string>"


def random_cubes(seed, owners, each):
    rng = random.Random(seed)
    return [
        (o, o * 100 + i, *[rng.sample(v, rng.randint(1, len(v))) for v in DOMAIN.values()]) for o in range(owners) for i in range(each)
    ]


def fields(cubes, by=0):
    return [(c[by], *f) for c in cubes for f in product(*c[2:])]


def unfolded(df, *columns):
    return [tuple(r) for r in C.unfold(df, KEYS).select(*columns, *KEYS).collect()]


def test_disjoint_cubes_hold_each_field_once(spark):
    cubes = random_cubes(1, 6, 5)
    for most in (256, 2):
        found = B.without_repeated_fields(spark.createDataFrame(cubes, SCHEMA), KEYS, ["owner"], most)
        assert sorted(unfolded(found, "owner")) == sorted(set(fields(cubes)))
    assert found.count() < len(set(fields(cubes)))


def test_difference_and_common_part_as_cubes(spark):
    left, right = random_cubes(2, 6, 3), random_cubes(3, 6, 2)
    l, r = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    taken = set(fields(right))
    rest = B.subtract(l, r, KEYS, "cube_id", "param", ["owner"])
    assert sorted(unfolded(rest, "cube_id")) == sorted((c[1], *f) for c in left for f in product(*c[2:]) if (c[0], *f) not in taken)
    both = B.common(l, r, KEYS, "cube_id", "param", ["owner"])
    assert sorted(unfolded(both, "cube_id")) == sorted((c[1], *f) for c in left for f in product(*c[2:]) if (c[0], *f) in taken)
    sides = unfolded(B.compare(l, r, KEYS, ["owner"], "param"), "owner", "side")
    want = {(o, "both" if (o, *f) in taken else "left", *f) for o, *f in fields(left)}
    want |= {(o, "right", *f) for o, *f in fields(right) if (o, *f) not in set(fields(left))}
    assert sorted(sides) == sorted(want)


def test_one_cube_less_another_is_one_cube_a_key_at_most(spark):
    schema = "cube_id int, level array<string>, param array<string>, step array<string>"
    left = spark.createDataFrame([(1, *DOMAIN.values())], schema)
    inner = spark.createDataFrame([(9, ["500"], ["t", "u"], ["6"])], schema)
    rest = B.subtract(left, inner, KEYS, "cube_id", "step")
    assert rest.count() == 3
    assert rest.agg(F.sum(C.field_count(KEYS))).first()[0] == 3 * 4 * 4 - 2
    assert B.subtract(left, left, KEYS, "cube_id", "step").count() == 0
    assert B.common(left, inner, KEYS, "cube_id", "step").count() == 1


def joins(plan):
    children = plan.children()
    here = [plan] if plan.nodeName() == "Join" else []
    return here + [j for i in range(children.size()) for j in joins(children.apply(i))]


def test_a_cube_goes_to_each_value_without_its_list(spark):
    schema = "cube_id int, level array<string>, param array<string>, step array<string>"
    steps = [str(i) for i in range(2000)]
    left = spark.createDataFrame([(1, ["100"], ["t"], steps), (2, ["500"], ["q", "t"], [None, "7", "8"])], schema)
    right = spark.createDataFrame([(9, ["100", "500"], ["t"], steps[::2]), (10, ["100", "500"], ["t", "u"], [*steps[1::2], None])], schema)
    met = B.parts_in_common(left, right, KEYS, "cube_id", "step")
    sent = [a for j in joins(met._jdf.queryExecution().optimizedPlan()) for a in (j.right().output().apply(i) for i in range(j.right().output().size()))]
    assert [a.dataType().simpleString() for a in sent if a.name() == "r_step"] == ["string"]
    # parts that differ in that key only are one
    parts = {r["cube_id"]: [(p["level"], p["param"], set(p["step"])) for p in r["parts"]] for r in met.collect()}
    assert parts == {1: [(["100"], ["t"], set(steps))], 2: [(["500"], ["t"], {None, "7", "8"})]}
    assert unfolded(B.subtract(left, right, KEYS, "cube_id", "step"), "cube_id") == [(2, "500", "q", s) for s in (None, "7", "8")]


def test_a_billion_granules_are_counted_from_the_lists(spark):
    values = [str(i) for i in range(1000)]
    request = spark.createDataFrame([(1, 1, values, values, values)], "dataset int, request_id int, level array<string>, param array<string>, step array<string>")
    rules = [(1, values[:700], values, values[:900]), (1, values[300:], values[:500], values), (1, values[100:400], values[200:], values[50:])]
    allowed = spark.createDataFrame(rules, "dataset int, level array<string>, param array<string>, step array<string>")
    begun = time.time()
    got = P.count_granules(P.granule_boxes(request, allowed, KEYS), KEYS).first()["n_granules"]
    assert time.time() - begun < 60
    a, b, c = [[(0, 700), (0, 1000), (0, 900)], [(300, 1000), (0, 500), (0, 1000)], [(100, 400), (200, 1000), (50, 1000)]]

    def size(*boxes):
        n = 1
        for spans in zip(*boxes, strict=True):
            n *= max(0, min(e for _, e in spans) - max(s for s, _ in spans))
        return n

    assert got == size(a) + size(b) + size(c) - size(a, b) - size(a, c) - size(b, c) + size(a, b, c)


def plain_merge(cubes):
    """Rounds of merging of (place, lists by key): the best key first, until no key saves a cube."""
    while True:
        groups = {}
        for k in KEYS:
            groups[k] = {}
            for cube in sorted(cubes):
                groups[k].setdefault(tuple(tuple(sorted(cube[1 + i])) for i, o in enumerate(KEYS) if o != k), []).append(cube)
        best = min(KEYS, key=lambda k: len(groups[k]))
        if len(groups[best]) == len(cubes):
            return sorted(cubes)
        at = 1 + KEYS.index(best)
        cubes = [(*g[0][:at], list(dict.fromkeys(v for c in g for v in c[at])), *g[0][at + 1 :]) for g in groups[best].values()]


@pytest.mark.parametrize("seed", [5, 6])
def test_merge_to_a_fixpoint_in_the_order_first_seen(spark, seed):
    rng = random.Random(seed)
    some = {k: v[:2] for k, v in DOMAIN.items()}
    cubes = [(o, o * 100 + i, *[rng.sample(v, rng.randint(1, 2)) for v in some.values()]) for o in range(8) for i in range(7)]
    merged = C.merge_cubes(spark.createDataFrame(cubes, SCHEMA), KEYS, ["owner"], "cube_id").collect()
    want = [(o, *c) for o in range(8) for c in plain_merge([c[1:] for c in cubes if c[0] == o])]
    assert sorted(tuple(r) for r in merged) == sorted(want)
    assert len(want) < len(cubes)
    barred = C.merge_cubes(spark.createDataFrame(cubes, SCHEMA), KEYS, ["owner"], "cube_id", barred=KEYS)
    assert barred.count() == len(cubes)
