import pytest
from pyspark.sql import functions as F

from skyloom.operators import rules as V
from skyloom.operators.rules import Rule

LIST = "array<string>"
CASES = [
    ("scalar to list", "string", "1", Rule("a"), ["1"], None),
    ("list to scalar", LIST, ["1"], Rule("a", scalar=True), "1", None),
    ("list of two is no scalar", LIST, ["1", "2"], Rule("a", scalar=True), None, "request['a']: ['1', '2'] is not of type 'string'"),
    ("text to integer", "string", "1", Rule("a", scalar=True, kind="integer"), 1, None),
    ("fraction is no integer", "string", "1.5", Rule("a", scalar=True, kind="integer"), None, "request['a']: '1.5' is not a valid integer"),
    ("text to number", "string", "1.5", Rule("a", scalar=True, kind="number"), 1.5, None),
    ("float that is whole", "double", 1.0, Rule("a", scalar=True, kind="integer"), 1, None),
    ("number to text 1", "int", 1, Rule("a", scalar=True), "1", None),
    ("number to text 2", "double", 1.0, Rule("a", scalar=True), "1.0", None),
    ("split 1", "string", "r/gg/b", Rule("a", split_on="/"), ["r", "gg", "b"], None),
    ("split 2", LIST, ["r/gg", "b", "c/d"], Rule("a", split_on="/"), ["r", "gg", "b", "c", "d"], None),
    ("split to integers", "string", "40/7/7", Rule("a", split_on="/", kind="integer"), [40, 7, 7], None),
    ("separator is no pattern", "string", "1|2", Rule("a", split_on="|"), ["1", "2"], None),
    ("long enough", LIST, ["ozone", "rain"], Rule("a", min_length=4, delete_if_short=True), ["ozone", "rain"], None),
    ("short ones go", LIST, ["fog", "rain", ""], Rule("a", min_length=4, delete_if_short=True), ["rain"], None),
    ("short ones stay", LIST, ["fog"], Rule("a", min_length=4), None, "request['a'][0]: 'fog': string is too short. Should have at least 4 character(s)"),
    ("repeats go", LIST, ["b", "a", "b"], Rule("a", unique="remove"), ["b", "a"], None),
    ("repeats are an error", LIST, ["b", "a", "b"], Rule("a", unique="reject"), None, "request['a']: has repeated values in the list, e.g. 'b'"),
    ("repeats after rewriting", LIST, ["2020-01-01", "20200101"], Rule("a", format="date", allowed_formats=["yyyyMMdd"], unique="remove"), ["2020-01-01"], None),
    ("too few", LIST, ["x"], Rule("a", min_items=2), None, "request['a']: ['x']: list has too few items. Should have at least 2"),
    ("too many", LIST, ["x", "y"], Rule("a", max_items=1), None, "request['a']: ['x', 'y'] list has too many items. Should have no more than 1"),
    ("exact number", LIST, ["x", "y"], Rule("a", min_items=1, max_items=1), None, "request['a']: ['x', 'y']: list has too many items. Should have exactly 1"),
    ("missing", LIST, None, Rule("a", required=True), None, "request: missing mandatory key: 'a'"),
    ("default", LIST, None, Rule("a", required=True, default=["z"]), ["z"], None),
    ("pattern", LIST, ["ab"], Rule("a", pattern="^b"), None, "request['a'][0]: invalid value: 'ab'. Valid values must match regular expression '^b'"),
    ("pattern not shown", LIST, ["ab"], Rule("a", pattern="^b", show_pattern=False), None, "request['a'][0]: invalid value: 'ab'"),
    ("date", LIST, ["2020-13-01"], Rule("a", format="date"), None, "request['a'][0]: \"2020-13-01\" is not a valid date. Expected format is yyyy-mm-dd"),
    ("date rewritten", LIST, ["20200131"], Rule("a", format="date", allowed_formats=["yyyyMMdd"]), ["2020-01-31"], None),
    ("date to range", LIST, ["2020-01-31"], Rule("a", format="date range"), ["2020-01-31/2020-01-31"], None),
    ("rewritten date to range", LIST, ["20200131"], Rule("a", format="date range", allowed_formats=["yyyyMMdd"]), ["2020-01-31/2020-01-31"], None),
    ("range reversed", LIST, ["2020-01-31/2020-01-30"], Rule("a", format="date range"), None, "request['a'][0]: '2020-01-31/2020-01-30' is not a valid date range"),
    ("numeric text", LIST, ["x"], Rule("a", format="numeric string"), None, "request['a'][0]: 'x' is not a valid numeric string"),
    ("enumeration", LIST, ["x"], Rule("a", allowed=["y"]), None, "request['a'][0]: 'x' is not one of ['y']"),
    ("minimum by place", LIST, ["0", "0", "-91"], Rule("a", kind="number", minimum={2: -90.0}), None, "request['a'][2]: -91.0 is less than the minimum of -90.0"),
]


@pytest.mark.parametrize("name, dtype, value, rule, want, message", CASES, ids=[c[0] for c in CASES])
def test_rule(spark, name, dtype, value, rule, want, message):
    df = spark.createDataFrame([(1, value)], f"request_id int, a {dtype}")
    good, rejects = V.enforce(df, [rule])
    if message is None:
        assert good.first()["a"] == want
        assert rejects.count() == 0
    else:
        assert good.count() == 0
        assert [r["message"] for r in rejects.collect()] == [message]


def test_messages_keep_the_order_of_the_rules_and_are_unique(spark):
    df = spark.createDataFrame([(1, None, ["x", "x"])], f"request_id int, a {LIST}, b {LIST}")
    rules = [Rule("b", allowed=["y"], unique="reject"), Rule("a", required=True)]
    _, rejects = V.enforce(df, rules)
    assert [r["message"] for r in rejects.orderBy("place").collect()] == [
        "request['b']: has repeated values in the list, e.g. 'x'",
        "request['b'][0]: 'x' is not one of ['y']",
        "request['b'][1]: 'x' is not one of ['y']",
        "request: missing mandatory key: 'a'",
    ]


def test_archive_rules(spark):
    from pyspark.sql import functions as F

    requests = [
        ({"param": ["Z", "T"], "ArEa": ["0", "0"], "grid": ["1", "1"]}, []),
        ({}, ["request: {} should be non-empty"]),
        ({" ": ["1"]}, ["request: ' ' is an invalid key name"]),
        ({"p": []}, ["request['p']: []: list has too few items. Should have at least 1"]),
        ({"p": ["1", "1"]}, ["request['p']: has repeated values in the list, e.g. '1'"]),
        ({"p": [" "]}, ["request['p'][0]: invalid value: ' '"]),
    ]
    df = spark.createDataFrame([(r,) for r, _ in requests], "r map<string,array<string>>")
    got = [r[0] for r in df.select(V.archive_problems(F.col("r"))).collect()]
    assert got == [m for _, m in requests]


def test_unknown_keys(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([({"a": "1", "x1": "2", "b": "3"},)], "r map<string,string>")
    row = df.select(
        F.map_keys(V.remove_unknown_keys(F.col("r"), ["a"], ["^x"])).alias("kept"),
        F.map_keys(V.remove_unknown_keys(F.col("r"), ["a"], removable=["b"])).alias("listed"),
        V.unknown_key_message(F.col("r"), ["a"]).alias("message"),
    ).first()
    assert (row["kept"], row["listed"], row["message"]) == (["a", "x1"], ["a", "x1"], "request: Invalid key names: 'b', 'x1'")


def test_first_repeated_value_of_long_lists(spark):
    rows = [(1, ["b", "a", "c", "a", "b"]), (2, ["a", None, None]), (3, []), (4, None), (5, [str(i) for i in range(20000)] + ["7", "3"])]
    lists = spark.createDataFrame(rows, "i int, values array<string>")
    got = {r["i"]: r["first"] for r in lists.select("i", V.first_repeated(F.col("values")).alias("first")).collect()}
    assert got == {1: "b", 2: None, 3: None, 4: None, 5: "3"}
