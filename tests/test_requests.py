import pytest
from pyspark.sql import functions as F

from skyloom.errors import ConfigurationError, InvalidRequest
from skyloom.operators import catalogue as K
from skyloom.operators import cubes as C
from skyloom.operators import requests as R
from skyloom.sources import documents as J

SOURCES = [
    {"source": "tower", "values": {"height": ["2", "10"], "kind": ["gust"]}, "required": ["height"]},
    {"source": "ship", "values": {"height": ["2", "10", "25"], "kind": ["swell", "gust"]}},
]


def test_requests_for_sources(spark):
    df = spark.createDataFrame(
        [(1, ["10", "2"], ["gust", "swell"]), (2, ["25"], ["gust"]), (3, None, ["swell"]), (4, None, ["gust"])],
        "request_id int, height array<string>, kind array<string>",
    )
    got = {(r["request_id"], r["source"]): (r["height"], r["kind"]) for r in R.requests_for_sources(df, SOURCES, ["height", "kind"]).collect()}
    assert got == {
        (1, "tower"): (["10", "2"], ["gust"]),
        (1, "ship"): (["10", "2"], ["gust", "swell"]),
        (2, "ship"): (["25"], ["gust"]),
        (3, "ship"): (None, ["swell"]),
        (4, "ship"): (None, ["gust"]),
    }


def test_mapping_order(spark):
    df = spark.createDataFrame([(1, ["a", "z"], None)], "request_id int, p array<string>, t array<string>")
    mapping = {
        "defaults": {"t": ["00"], "p": ["never"]},
        "remap": {"p": {"a": "b"}},
        "patches": [{"from": "p", "to": "levtype", "mapping": {"b": "sfc"}}],
        "rename": {"p": "param"},
        "force": {"t": ["12"]},
    }
    row = R.apply_mapping(df, mapping).first()
    assert (row["param"], row["levtype"], row["t"]) == (["b", "z"], ["sfc", "z"], ["12"])


def test_dates_of_a_mapping(spark):
    rows = [
        (1, ["2011-02-03", "2011-02-01/2011-02-02", ""], None, None, None),
        (2, None, ["2011"], ["2", "3"], ["28", "30"]),
        (3, None, ["2011"], ["2"], ["30"]),
        (4, ["2011-02-03/x"], None, None, None),
        (5, None, ["2011"], None, ["1"]),
        (6, ["1/2/3"], ["2011"], ["1"], ["1"]),
    ]
    df = spark.createDataFrame(rows, "request_id int, date array<string>, year array<string>, m array<string>, day array<string>")
    mapping = {"rename": {"m": "month"}, "options": {"wants_dates": True, "wants_intervals": True, "date_format": "%d.%m.%Y"}}
    got = {r["request_id"]: r for r in R.apply_mapping(df, mapping).collect()}
    assert got[1]["date"] == ["/", "01.02.2011/01.02.2011", "02.02.2011/02.02.2011", "03.02.2011/03.02.2011"]
    assert got[2]["date"] == ["28.02.2011/28.02.2011", "28.03.2011/28.03.2011", "30.03.2011/30.03.2011"] and got[2]["year"] is None
    assert got[3]["mapping_problem"] == "no valid dates from year, month and day"
    assert got[4]["mapping_problem"] == got[6]["mapping_problem"] == "a date or date range cannot be read"
    assert got[5]["date"] is None and got[5]["day"] == ["1"] and got[5]["mapping_problem"] is None
    with pytest.raises(ConfigurationError):
        R.apply_mapping(df, {"options": {"wants_dates": True, "date_format": "%y"}})


def test_safe_rename(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert R.safe_rename(df, {"a": "c", "b": "a"}).columns == ["c", "a"]
    with pytest.raises(ConfigurationError):
        R.safe_rename(df, {"a": "b"})
    with pytest.raises(ConfigurationError):
        R.safe_rename(df, {"a": "b", "b": "a"})


def test_envelope_keeps_first_seen_order(spark):
    df = spark.createDataFrame(
        [(1, 1, ["1"], ["1", "2"], None), (1, 2, ["2"], ["2", "3"], ["x"]), (1, 3, ["1"], None, ["x"])],
        "job int, n int, a array<string>, b array<string>, c array<string>",
    )
    got = {r["key"]: r["values"] for r in C.envelope(df, ["a", "b", "c"], ["job"], "n").collect()}
    assert got == {"a": ["1", "2"], "b": ["1", "2", "3"], "c": ["x"]}


def test_canonical_values(spark):
    df = spark.createDataFrame([(["10", "9", "1"],), (["b", "10", "a"],)], "v array<string>")
    assert [r[0] for r in df.select(C.canonical_values(F.col("v"))).collect()] == [["1", "9", "10"], ["10", "a", "b"]]


def test_fingerprint_does_not_depend_on_key_order(spark):
    df = spark.createDataFrame([(["1"], ["x"])], "a array<string>, b array<string>")
    one = F.create_map(F.lit("a"), F.col("a"), F.lit("b"), F.col("b"))
    two = F.create_map(F.lit("b"), F.col("b"), F.lit("a"), F.col("a"))
    row = df.select(
        R.fingerprint(one, F.lit(False)), R.fingerprint(two, F.lit(False)), R.fingerprint(one, F.lit(True))
    ).first()
    assert row[0] == row[1] != row[2]


def test_split_on_several_keys(spark):
    df = spark.createDataFrame([(1, ["1", "2"], ["3", "4"]), (2, ["5"], ["6", "7"])], "i int, a array<string>, b array<string>")
    got = sorted((r["i"], r["a"][0], r["b"][0]) for r in C.split_on(df, ["a", "b"]).collect())
    assert got == [(1, "1", "3"), (1, "1", "4"), (1, "2", "3"), (1, "2", "4"), (2, "5", "6"), (2, "5", "7")]


def test_documents(spark):
    text = '{"a": ["1", "2"], "b": 3, "c": null, "d": "x"}'
    row = J.requests(spark.createDataFrame([(1, text)], "id int, text string"), "text", ["id"]).first()
    assert row["keys"] == {"a": ["1", "2"], "b": ["3"], "c": [], "d": ["x"]}
    rules = spark.createDataFrame([('[{"a": ["2", "1", "2"], "b": "x"}, {"a": "3"}]',)], "text string")
    got = J.key_columns(J.constraints(rules, "text", []), ["a", "b"], ["constraint_no"]).orderBy("constraint_no").collect()
    assert [tuple(r) for r in got] == [(0, ["1", "2"], ["x"]), (1, ["3"], None)]


def test_form_documents(spark):
    text = """[{"name": "v", "label": "V", "type": "StringListWidget", "details": {"values": ["a", "b"]}},
     {"name": "g", "label": "G", "type": "StringListArrayWidget", "details": {"groups": [{"values": ["p", "q"]},
      {"details": {"groups": [{"values": ["r"]}, {"details": {"groups": [{"values": ["s"]}]}}]}}]}},
     {"name": "d", "label": "D", "type": "DateRangeWidget", "details": {"minStart": "2000-01-01", "maxEnd": "2020-12-31"}},
     {"name": "m", "label": "M", "type": "LicenceWidget", "details": {}}]"""
    widgets = J.forms(spark.createDataFrame([(text,)], "text string"), "text", [])
    got = {tuple(r) for r in R.form_values(widgets).collect()}
    assert got == {("v", "a"), ("v", "b"), ("g", "p"), ("g", "q"), ("g", "r"), ("g", "s"), ("d", "2000-01-01/2020-12-31")}
    assert [r["name"] for r in R.unsupported_widgets(widgets).collect()] == ["m"]


def test_tags_need_every_field(spark):
    fields = spark.createDataFrame([(1, "a", "x"), (1, "b", "x"), (2, "a", "y"), (2, None, "y")], "request_id int, p string, t string")
    conditions = {"one": [{"p": ["a"]}, {"p": ["b"], "t": ["x"]}], "any": [{}]}
    got = sorted(tuple(r) for r in K.conditional_tags(fields, conditions, ["request_id"]).collect())
    assert got == [(1, "any"), (1, "one"), (2, "any")]


def test_merge_then_unfold_gives_the_same_fields(spark):
    fields = spark.createDataFrame([(1, a, b, c) for a in "xyz" for b in "pq" for c in "12" if (a, b, c) != ("x", "p", "1")], "i int, a string, b string, c string")
    cubes = C.merge(fields, ["a", "b", "c"], ["i"])
    assert cubes.count() < fields.count()
    again = C.unfold(cubes, ["a", "b", "c"]).select("i", "a", "b", "c")
    assert again.exceptAll(fields).isEmpty() and fields.exceptAll(again).isEmpty()


def test_split_and_chunk_sizes(spark):
    cubes = spark.createDataFrame([(1, ["a", "b", "c"], ["1", "2"]), (2, ["d"], ["1", "2", "3"])], "i int, a array<string>, b array<string>")
    sizes = C.split(cubes, ["a", "b"], 4).groupBy("i", "piece").count().collect()
    assert max(r["count"] for r in sizes) <= 4 and sum(r["count"] for r in sizes) == 9
    chunks = {r["chunk"]: r["count"] for r in C.chunk(cubes, ["a", "b"], ["i"], 4).groupBy("chunk").count().collect()}
    assert chunks == {0: 4, 1: 4, 2: 1}
    assert C.chunk(cubes, ["a", "b"], ["i"], 4, max_groups=2).count() == 8
    first, rest = C.take_first(cubes, ["a", "b"], 2)
    assert (first.count(), rest.count()) == (4, 5)


def test_lists_of_dates_expand_and_compress(spark):
    df = spark.createDataFrame([(1, ["2020-01-03", "20200101/20200102", "2020-01-07"])], "i int, dates array<string>")
    days = df.select("i", F.explode(C.expand_dates(F.col("dates"))).alias("d"))
    assert [r["span"] for r in C.runs_of_dates(days, ["i"]).orderBy("start").collect()] == ["2020-01-01/2020-01-03", "2020-01-07"]


def test_scan_errors(spark):
    from skyloom.errors import NoData
    from skyloom.sources.gridstore import scan

    grid = spark.createDataFrame([("t", "2020-01-01 00:00:00", 10.0, 20.0, 1.0)], "variable string, valid_time string, latitude double, longitude double, value double")
    grid = grid.withColumn("valid_time", F.col("valid_time").cast("timestamp_ntz"))
    box = (20.0, 10.0, 0.0, 30.0)
    assert scan(grid, ["t"], "2020", "2020", box=box).count() == 1
    with pytest.raises(InvalidRequest):
        scan(grid, ["t", "u"], "2020", "2020", box=box)
    with pytest.raises(NoData):
        scan(grid, ["t"], "2021", "2021", box=box)
    with pytest.raises(NoData):
        scan(grid, ["t"], "2020", "2020", box=(5.0, 0.0, 0.0, 5.0))
    with pytest.raises(InvalidRequest):
        scan(grid, ["t"], "2020", "2020")


def test_values_found_on_the_map_come_after_the_given_ones(spark):
    requests = spark.createDataFrame([(1, ["ground"]), (2, ["ground"]), (3, None)], "request_id int, source array<string>")
    found = spark.createDataFrame([(1, ["satellite"]), (3, ["ship"])], "request_id int, values array<string>")
    got = {r["request_id"]: r["source"] for r in K.append_values(requests, found, "source").collect()}
    assert got == {1: ["ground", "satellite"], 2: ["ground"], 3: ["ship"]}
    fresh = {r["request_id"]: r["country"] for r in K.append_values(requests, found, "country").collect()}
    assert fresh == {1: ["satellite"], 2: None, 3: ["ship"]}
