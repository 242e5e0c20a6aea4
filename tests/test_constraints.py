"""Constraints and open values against the rule written out in Python, on random tables."""

import random
from itertools import product

import pytest

from skyloom.errors import ConfigurationError
from skyloom.operators import constraints as N
from skyloom.operators import forms
from skyloom.plans.planning import apply_constraints

TEXTS = "array<string>"
DOMAIN = {"sensor": ["radar", "lidar", "buoy"], "band": ["k1", "k2", "k3", "k4"], "orbit": ["up", "down"]}
KEYS = list(DOMAIN)


def rows(spark, entries, keys, id_name):
    schema = f"dataset int, {id_name} int, " + ", ".join(f"{k} {TEXTS}" for k in keys)
    data = [(1, i, *[list(e[k]) if k in e else None for k in keys]) for i, e in enumerate(entries)]
    return spark.createDataFrame(data, schema)


def form_table(spark, form):
    return spark.createDataFrame([(1, k, v) for k, vs in form.items() for v in vs], "dataset int, key string, value string")


def states(df, n, keys):
    found = [{k: set() for k in keys} for _ in range(n)]
    for r in df.collect():
        found[r["request_id"]][r["key"]].add(r["value"])
    return found


def some(rng, values):
    return sorted(rng.sample(values, rng.randint(1, len(values))))


def random_entries(seed, n, gap):
    rng = random.Random(seed)
    return [{k: some(rng, v) for k, v in DOMAIN.items() if rng.random() > gap} for _ in range(n)]


@pytest.fixture(scope="module")
def world():
    rules = [r for r in random_entries(11, 7, 0.25) if r]
    form = {k: {v for r in rules for v in r.get(k, [])} for k in KEYS}
    return rules, form, random_entries(12, 40, 0.4)


def has_common(a, b):
    return bool(set(a) & set(b))


def open_mixed(rules, form, selection):
    chosen = [k for k in KEYS if k in selection]
    if not chosen:
        return form
    out = {}
    for key in KEYS:
        others = [k for k in chosen if k != key]
        if not others:
            out[key] = form[key]
            continue
        fitting = [r for r in rules if all(k not in r or has_common(r[k], selection[k]) for k in others)]
        out[key] = {v for r in fitting for v in r.get(key, [])}
    return out


def test_mixed_rule(spark, world):
    rules, form, selections = world
    df = forms.form_state_mixed(rows(spark, selections, KEYS, "request_id"), rows(spark, rules, KEYS, "constraint_id"), KEYS, form_table(spark, form))
    assert states(df, len(selections), KEYS) == [open_mixed(rules, form, s) for s in selections]


def test_homogeneous_rule(spark, world):
    rules, _, selections = world
    asked, allowed = rows(spark, selections, KEYS, "request_id"), rows(spark, rules, KEYS, "constraint_id")

    def fitting(selection, skip=None):
        wanted = [k for k in selection if k != skip]
        return [r for r in rules if all(k in r and has_common(r[k], selection[k]) for k in wanted)]

    def values(found, key):
        return {v for r in found for v in r.get(key, [])}

    n = len(selections)
    possible = [{k: values(fitting(s), k) for k in KEYS} for s in selections]
    assert states(forms.possible_values(asked, allowed, KEYS), n, KEYS) == possible
    state = [{k: values(fitting(s, k), k) for k in KEYS} for s in selections]
    assert states(forms.form_state(asked, allowed, KEYS), n, KEYS) == state


def test_intersection_keeps_the_order_of_the_request(spark, world):
    rules, _, selections = world
    rng = random.Random(13)
    selections = [{k: rng.sample(v, len(v)) for k, v in s.items()} for s in selections]
    cut = N.intersect(rows(spark, selections, KEYS, "request_id"), rows(spark, rules, KEYS, "constraint_id"), KEYS).collect()
    want = {}
    for (i, s), (j, r) in product(enumerate(selections), enumerate(rules)):
        if all(k in s and has_common(s[k], r[k]) for k in r):
            want[i, j] = tuple([v for v in s[k] if v in r[k]] if k in r else None for k in KEYS)
    assert {(r.request_id, r.constraint_id): tuple(r[k] for k in KEYS) for r in cut} == want
    unmet = N.without_valid_combination(rows(spark, selections, KEYS, "request_id"), N.intersect(
        rows(spark, selections, KEYS, "request_id"), rows(spark, rules, KEYS, "constraint_id"), KEYS
    ))
    assert {r.request_id for r in unmet.collect()} == set(range(len(selections))) - {i for i, _ in want}


def test_datasets_without_constraints_pass(spark):
    asked = spark.createDataFrame([(1, 0, ["radar"], "x"), (2, 1, ["sonar"], "y"), (1, 2, ["sonar"], "z")], f"dataset int, request_id int, sensor {TEXTS}, note string")
    allowed = rows(spark, [{"sensor": ["radar"]}], ["sensor"], "constraint_id")
    got = {(r.request_id, r.constraint_id, tuple(r.sensor), r.note) for r in N.intersect_or_pass(asked, allowed, ["sensor"]).collect()}
    assert got == {(0, 0, ("radar",), "x"), (1, None, ("sonar",), "y")}
    none = allowed.where("false")
    assert N.intersect_or_pass(asked, none, ["sensor"]).count() == 3


def overlap(a, b):
    (s, e), (t, f) = ((x.split("/")[0], x.split("/")[-1]) for x in (a, b))
    return (max(s, t), min(e, f)) if max(s, t) <= min(e, f) else None


def test_date_ranges_decide_by_overlap(spark):
    rng = random.Random(17)

    def span():
        months = sorted(rng.sample(range(1, 13), 2))
        return f"2011-{months[0]:02}-{rng.randint(1, 28):02}/2011-{months[1]:02}-{rng.randint(1, 28):02}"

    keys = ["sensor", "when"]
    rules = [{"sensor": some(rng, DOMAIN["sensor"]), "when": [span() for _ in range(rng.randint(1, 2))]} for _ in range(6)]
    form = {k: {v for r in rules for v in r[k]} for k in keys}
    selections = [{"when": [span()]} for _ in range(8)] + [{"when": [span()], "sensor": some(rng, DOMAIN["sensor"])} for _ in range(8)]
    asked, allowed = rows(spark, selections, keys, "request_id"), rows(spark, rules, keys, "constraint_id")

    def meets(s, r):
        return any(overlap(a, b) for a in s["when"] for b in r["when"])

    want = []
    for s in selections:
        by_date = [r for r in rules if meets(s, r)]
        sensors = {v for r in by_date for v in r["sensor"]}
        when = {v for r in rules if has_common(r["sensor"], s["sensor"]) for v in r["when"]} if "sensor" in s else form["when"]
        want.append({"sensor": sensors, "when": when})
    df = forms.form_state_mixed(asked, allowed, keys, form_table(spark, form), ranges=["when"])
    assert states(df, len(selections), keys) == want
    cut = N.intersect(asked, allowed, keys, ranges=["when"]).collect()
    for r in cut:
        s, rule = selections[r.request_id], rules[r.constraint_id]
        assert r.when == ["/".join(o) for a in s["when"] for b in rule["when"] if (o := overlap(a, b))]
    met = {(i, j) for (i, s), (j, r) in product(enumerate(selections), enumerate(rules)) if "sensor" in s and meets(s, r) and has_common(s["sensor"], r["sensor"])}
    assert {(r.request_id, r.constraint_id) for r in cut} == met


def test_dates_left_empty_are_no_selection(spark):
    keys = ["orbit", "when"]
    rules = rows(spark, [{"orbit": ["up"], "when": ["2011-02-01/2011-03-01"]}], keys, "constraint_id")
    form = {"orbit": {"up", "down"}, "when": {"2011-02-01/2011-03-01"}}
    asked = rows(spark, [{"orbit": ["down"], "when": [""]}], keys, "request_id")
    assert states(forms.form_state_mixed(asked, rules, keys, form_table(spark, form), ranges=["when"]), 1, keys) == [form]


def test_keys_without_constraints_stay_open_and_do_not_count(spark):
    keys = ["band", "orbit"]
    rules = rows(spark, [{"band": ["k1"]}, {"band": ["k2"]}], keys, "constraint_id")
    form = form_table(spark, {"band": {"k1", "k2"}, "orbit": {"up", "down"}})
    asked = rows(spark, [{"band": ["k2"], "orbit": ["up"]}], keys, "request_id")
    for method in ("mixed", "homogeneous"):
        assert states(apply_constraints(asked, rules, form, keys, method), 1, keys) == [{"band": {"k1", "k2"}, "orbit": {"up", "down"}}]
    with pytest.raises(ConfigurationError):
        apply_constraints(asked, rules, form, keys, "by guess")


def test_places_on_the_map_alone_open_nothing(spark):
    keys = ["sensor"]
    rules = rows(spark, [{"sensor": ["radar"]}], keys, "constraint_id")
    asked = spark.createDataFrame([(1, 0, None, ["4.5"]), (1, 1, None, None)], f"dataset int, request_id int, sensor {TEXTS}, location_x {TEXTS}")
    got = states(forms.form_state_mixed(asked, rules, keys, form_table(spark, {"sensor": {"radar"}})), 2, keys)
    assert got == [{"sensor": set()}, {"sensor": {"radar"}}]


def test_many_constraints_and_long_dictionaries(spark, monkeypatch):
    """Lists of a few constraints and bitmaps of several words say the same."""
    rng = random.Random(19)
    domain = {"sensor": [f"s{i:03}" for i in range(150)], "band": [f"b{i}" for i in range(64)], "orbit": ["up", "down"]}
    rules = [{k: rng.sample(v, rng.randint(1, min(12, len(v)))) for k, v in domain.items() if rng.random() > 0.2} for _ in range(60)]
    rules = [r for r in rules if r]
    selections = [{k: rng.sample(v, rng.randint(1, min(20, len(v)))) for k, v in domain.items() if rng.random() > 0.4} for _ in range(25)]
    selections[0]["sensor"] = ["unheard of"]
    form = {k: {v for r in rules for v in r.get(k, [])} for k in KEYS}
    asked, allowed = rows(spark, selections, KEYS, "request_id"), rows(spark, rules, KEYS, "constraint_id")
    want = [open_mixed(rules, form, s) for s in selections]
    assert states(forms.form_state_mixed(asked, allowed, KEYS, form_table(spark, form)), len(selections), KEYS) == want
    parts = forms.coded(allowed, KEYS, ["dataset"], most=7)
    assert parts.count() > 5 and parts.selectExpr("max(size(_rules)) AS n").first().n < 25
    whole = forms.coded
    monkeypatch.setattr(forms, "coded", lambda *a, **o: whole(*a, **{**o, "most": 7}))
    assert states(forms.form_state_mixed(asked, allowed, KEYS, form_table(spark, form)), len(selections), KEYS) == want


def test_keys_that_no_form_has_are_rejected(spark):
    keys = ["band", "orbit", "sensor"]
    rules = rows(spark, [{"band": ["k1"]}], ["band"], "constraint_id")
    form = form_table(spark, {"orbit": {"up"}})
    asked = rows(spark, [{"band": ["k9"], "orbit": ["up"]}, {"sensor": ["radar"], "band": ["k1"]}, {}], keys, "request_id")
    assert [tuple(r) for r in forms.unknown_keys(asked, rules, form, keys).collect()] == [(1, "sensor", "invalid param 'sensor'")]
