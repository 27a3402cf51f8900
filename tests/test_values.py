"""Failed conversions, exact small numbers, bounds refused when rules are built, nested items in canonical form."""

import json
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import contractspark as cs
from contractspark.functions.canonical import canonical
from contractspark.functions.names import exact_text, number_text, quote, string_text
from contractspark.operators.expect import rules, summarize
from contractspark.spec import ContractError, ObjectSpec


def one(logical, physical, options=None, **more):
    return ObjectSpec.from_dict({"name": "t", "properties": [{"name": "x", "logicalType": logical, "physicalType": physical, "logicalTypeOptions": options or {}, **more}]})


def failed(spark, obj, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return {r.expectation: r.failed for r in summarize(cs.rename_cast(cs.convert(df, obj), obj), rules(obj)).collect()}


# ---- numbers and names --------------------------------------------------------------------------------------------------


@given(st.floats(allow_nan=False, allow_infinity=False))
def test_exact_text_is_the_number_and_has_no_exponent_within_38_digits(value):
    text = exact_text(value)
    assert float(text) == value
    if 1e-30 < abs(value) < 1e30 and len(repr(value)) < 12:
        assert "e" not in text and Decimal(text) == Decimal(repr(value))


def test_texts_that_rules_show_stay(spark):
    assert number_text(1e-05) == "1e-05" and exact_text(1e-05) == "0.00001" and exact_text(2.50) == "2.5" and exact_text(True) == "1" and exact_text(7) == "7"
    assert [r.text for r in rules(one("number", "DECIMAL(20,8)", {"multipleOf": 1e-05}))] == ["`x` % 1e-05 = 0"]
    assert quote("a`b") == "`a``b`" and string_text("it's \\d") == "'it''s \\\\d'"


def test_small_steps(spark):
    obj = one("number", "DECIMAL(20,8)", {"multipleOf": 1e-05})
    assert failed(spark, obj, ["0.00003", "0.00007", "0.000035", None]) == {"x_multiple_of": 1}


# ---- moment bounds ------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("bound", ["2020-02-30", "2021-02-29", "2020-13-01", "2020-00-10", "soon", "2020-01-01 25:00:00", "2020-01-01T10:61:00", "", "10:00"])
@pytest.mark.parametrize("logical, physical", [("date", "DATE"), ("timestamp", "TIMESTAMP"), ("timestamp", "TIMESTAMP_NTZ")])
def test_impossible_bounds_are_refused_when_rules_are_built(spark, logical, physical, bound):
    if physical == "DATE" and bound.startswith("2020-01-01"):
        return  # a date's text may go on with anything, as Spark casts it
    with pytest.raises(ContractError) as e:
        rules(one(logical, physical, {"minimum": bound}))
    assert e.value.code == "ODCS-OPT-001"


@pytest.mark.parametrize("bound", ["2020-02-29", "2000-02-29", "2020", "2020-7", "2020-07-01T10:00:00", "2020-07-01 10:00:00.5", "2020-07-01T10:00:00Z", "2020-07-01 10:00:00 +02:00", "2020-07-01 10:00:00 Europe/Paris"])
def test_good_bounds_run(spark, bound):
    obj = one("timestamp", "TIMESTAMP", {"minimum": bound})
    assert failed(spark, obj, ["1999-01-01 00:00:00", "2024-01-01 00:00:00", None]) == {"x_min": 1}


def test_time_bounds_of_another_shape_than_the_format(spark):
    obj = one("time", "STRING", {"format": "HH:mm", "minimum": "09:00:00", "maximum": "17:30"})
    assert failed(spark, obj, ["08:59", "09:00", "17:30", "17:31", None]) == {"x_min": 1, "x_max": 1}
    assert failed(spark, one("time", "STRING", {"format": "hh.mm a", "minimum": "09.00 AM"}), ["08.59 AM", "09.01 AM"]) == {"x_min": 1}
    with pytest.raises(ContractError) as e:
        rules(one("time", "STRING", {"format": "HH:mm", "minimum": "noon"}))
    assert e.value.code == "ODCS-OPT-001"


# ---- nested items -------------------------------------------------------------------------------------------------------


def forms(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").withColumn("v", F.parse_json("t"))
    return [r.c for r in df.select("i", canonical(F.col("v"), df.schema["v"].dataType).alias("c")).orderBy("i").collect()]


def test_variant_forms(spark):
    same = [["1", "1.0", "1e0", "1.00"], ["0", "-0", "0.0", "-0.0"], ["0.5", "5e-1", "0.50"], ["100", "1e2", "100.000"], ["100000000000000000000", "1e20"],
            ['{"a": 1, "b": [1.0]}', '{"b": [1], "a": 1.0}'], ["12.125", "12.1250"], ["-3", "-3.0"]]
    flat = [t for group in same for t in group]
    got = dict(zip(flat, forms(spark, flat)))
    assert [len({got[t] for t in group}) for group in same] == [1] * len(same)
    assert len({got[group[0]] for group in same}) == len(same)
    apart = ['"1"', "1", '"1.0"', "[1]", '["1"]', "null", "true", '{"a": 1}', '{"a": "1"}', '{"a":{"b":1}}', "1.000000000000001", '"a\\"1.0"', '"a\\"1"', "10", "1e3", '{"1.0": 1}', '{"1": 1}']
    assert len(set(forms(spark, apart))) == len(apart)


NUMBERS = st.integers(-10 ** 6, 10 ** 6) | st.decimals(-1000, 1000, places=3).map(float)
VALUES = st.recursive(st.none() | st.booleans() | NUMBERS | st.text(st.characters(codec="ascii", exclude_categories=["Cc"]), max_size=4),
                      lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text("ab1.", min_size=1, max_size=2), x, max_size=3), max_leaves=6)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(VALUES, min_size=2, max_size=8))
def test_variant_forms_are_equal_exactly_for_equal_values(spark, values):

    def plain(v):  # Python holds True == 1
        return [plain(x) for x in v] if isinstance(v, list) else {k: plain(x) for k, x in v.items()} if isinstance(v, dict) else ("bool", v) if isinstance(v, bool) else v

    got = forms(spark, [json.dumps(v) for v in values])
    for a, x in zip(values, got):
        for b, y in zip(values, got):
            assert (plain(a) == plain(b)) == (x == y), (a, b, x, y)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_variant_forms_by_the_short_and_the_long_way_agree(spark, ansi):
    was = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        same = [["0", "-0.0", "0e0", "-0e5"], ["0.0000001", "1e-7", "0.00000010"], ["-0.5", "-5e-1"], ["12345678901234567", "12345678901234567.0"], ["1234567890123456", "1234567890123456.00e0"], ["-7", "-7e0", "-7.0"],
                ["0.1234567890123456", "1234567890123456e-16"], ['{"a\\\\": "1.0\\"2.0", "b": [1.0, -2, 3e0]}', '{"b": [1, -2.0, 3], "a\\\\": "1.0\\"2.0"}']]
        got = [forms(spark, group) for group in same]
        assert [len(set(g)) for g in got] == [1] * len(same) and len({g[0] for g in got}) == len(same), got
        assert got[1][0] == "0.0000001" and got[5][0] == "-7"
        apart = ["99999999999999999", "1e17", "1e18", "1.00000000000000001", "123456789012345678901234567890", "12345678901234567.5", "1.5", "15", '"1.50"', '"1.5"', "[1,1]", "[11]", "[1.1]"]
        assert len(set(forms(spark, apart))) == len(apart)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", was)


def test_variant_form_of_a_long_text(spark):
    long = "\\u00e9x 1.0 \\\" " * 20_000  # the regular expression may not go down a frame for each of its characters
    got = forms(spark, [f'{{"n": 1.0, "t": "{long}"}}', f'{{"t": "{long}", "n": 1e0}}'])
    assert got[0] == got[1] and got[0].startswith('{"n":1,')


def test_unique_items_of_maps_structs_and_variants(spark):
    obj = ObjectSpec.from_dict({"name": "t", "properties": [{"name": "x", "logicalType": "array", "physicalType": "ARRAY<STRUCT<m:MAP<STRING,INT>,v:INT>>", "logicalTypeOptions": {"uniqueItems": True}}]})
    rows = [([({"a": 1, "b": 2}, 1), ({"b": 2, "a": 1}, 1)],), ([({"a": 1}, 1), ({"a": 1}, 2)],), ([None, None],), ([],), (None,), ([(None, 1), (None, 2)],)]
    df = spark.createDataFrame(rows, "x array<struct<m:map<string,int>,v:int>>")
    assert [r.failed for r in summarize(df, rules(obj)).collect()] == [2]


# ---- failed conversions -------------------------------------------------------------------------------------------------


def counts(spark, obj, values):
    return [r.failed for r in cs.failure_counts(spark.createDataFrame([(v,) for v in values], "x string"), obj).collect()]


def test_failed_conversions(spark):
    assert counts(spark, one("date", "STRING", {"format": "yyyy-MM-dd"}), ["2020-02-30", "2020-02-29", "", None]) == [2]
    assert counts(spark, one("string", "STRING", {"format": "byte"}), ["YQ==", "*", None]) == [1]
    assert counts(spark, one("object", "STRING"), ["{}", "null", "{", "", None]) == [2]
    struct = one("object", "STRING", properties=[{"name": "k", "logicalType": "integer", "physicalType": "BIGINT"}])
    assert counts(spark, struct, ['{"k": 1}', '{"k": "x"}', '{"k": 1', '{"other": 1}', "null", "", "5", None]) == [4]
    array = one("array", "STRING", items={"name": "i", "logicalType": "integer", "physicalType": "INT"})
    assert counts(spark, array, ["[1, 2]", "[]", "null", "[1", '["x"]', "7", None]) == [3]
    assert counts(spark, one("integer", "STRING"), ["1", "x", None]) == [1]
    assert counts(spark, one("string", "STRING"), ["1", None]) == []


def test_result_has_failures_and_rejected_rows(spark):
    obj = ObjectSpec.from_dict({"name": "t", "properties": [{"name": "i", "logicalType": "integer", "physicalType": "STRING", "physicalName": "src"},
                                                            {"name": "day", "logicalType": "date", "physicalType": "STRING", "logicalTypeOptions": {"format": "yyyyMMdd"}}]})
    df = spark.createDataFrame([("1", "20200101"), ("x", "2020"), ("3", None)], "src string, day string")
    res = cs.apply_contract(df, obj, mode="lenient")
    assert [tuple(r) for r in res.failures().collect()] == [("i", 3, 1), ("day", 3, 1)]
    assert [(r.src, r.day, [tuple(f) for f in r["_failed"]]) for r in res.rejected().collect()] == [("x", "2020", [("i", "x"), ("day", "2020")])]
    assert sorted((r.i is None, r.day is None) for r in res.frame.collect()) == [(False, False), (False, True), (True, True)]
    plan = cs.failure_counts(df, obj)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1 and "Python" not in plan
