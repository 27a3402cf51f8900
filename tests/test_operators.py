"""Data operators on small literal DataFrames: NULLs, malformed text, empty input, odd names."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import contractspark as cs
from contractspark.spec import ContractSpec, ObjectSpec, object_spec

from .conftest import CONTRACTS


@pytest.fixture(scope="module")
def shop():
    with open(f"{CONTRACTS}/shop.contract.yaml") as f:
        return ContractSpec.from_yaml(f.read())


@pytest.fixture(scope="module")
def promo():
    with open(f"{CONTRACTS}/marketing/promo.yml") as f:
        return ContractSpec.from_yaml(f.read()).object("promo")


EXCL = cs.exclusion_set({"_ingest_file"})


def _client_df(spark):
    return spark.createDataFrame(
        [(1, 10, "a@b.io", 3, ["x"], "f1", "junk"), (0, 10, "bad", 0, ["x", "x"], "f1", "junk"),
         (2, 11, None, None, None, "f2", "junk"), (2, 11, "c@d.org", 5, [], "f2", "junk")],
        "`client id` long, region_id int, mail string, visits int, labels array<string>, _ingest_file string, "
        "extra string")


def test_read_schema(shop, spark):
    o = shop.object("client")
    s = cs.read_schema(o, EXCL)
    assert [f.name for f in s.fields] == ["client id", "region_id", "mail", "visits", "labels"]
    assert [f.nullable for f in s.fields] == [False, False, True, True, True]
    assert s["client id"].metadata == {"comment": "Surrogate key"}
    assert s["mail"].dataType == T.StringType()


def test_read_schema_converted_columns_load_as_string(promo):
    s = cs.read_schema(promo)
    assert s["launch_text"].dataType == T.StringType() and s["audience"].dataType == T.StringType()
    assert s["promo_id"].dataType == T.LongType()


def test_load_projection_drops_unknown_keeps_operational(shop, spark):
    out = cs.load(_client_df(spark), shop.object("client"), EXCL)
    assert out.columns == ["client id", "region_id", "mail", "visits", "labels", "_ingest_file"]


def test_load_missing_column(shop, spark):
    with pytest.raises(cs.ContractError):
        cs.load(_client_df(spark).drop("mail"), shop.object("client"), EXCL)


def test_rename_cast_and_rules(shop, spark):
    o = shop.object("client")
    checked = cs.rename_cast(cs.load(_client_df(spark), o, EXCL), o, EXCL)
    assert checked.columns == ["client_id", "region_id", "mail", "visits", "labels", "_ingest_file"]
    rl = cs.rules(o, checked.columns)
    assert [r.name for r in rl] == [
        "client_id_not_null", "client_id_min", "region_id_not_null", "mail_min_length", "mail_max_length",
        "mail_pattern", "visits_exclusive_min", "visits_multiple_of", "labels_min_items", "labels_max_items",
        "labels_unique_items"]
    assert [r.text for r in rl][7] == "`visits` % 1 = 0"
    assert {r.action for r in rl if r.column == "client_id"} == {"fail"}
    summary = {r.expectation: r.failed for r in cs.summarize(checked, rl).collect()}
    assert summary["client_id_min"] == 1 and summary["mail_min_length"] == 0 and summary["mail_pattern"] == 1
    assert summary["visits_exclusive_min"] == 1  # NULL passes, 0 fails
    assert summary["labels_unique_items"] == 1 and summary["labels_min_items"] == 1  # [] fails min, NULL passes
    ann = [r._violations for r in cs.annotate(checked, rl).orderBy("client_id", "visits").collect()]
    assert ann[0] == ["client_id_min", "mail_pattern", "visits_exclusive_min", "labels_unique_items"]


def test_gate_aborts_on_fail_rule(shop, spark):
    o = shop.object("client")
    checked = cs.rename_cast(cs.load(_client_df(spark), o, EXCL), o, EXCL)
    with pytest.raises(Exception) as e:
        cs.gate(checked, cs.rules(o, checked.columns)).count()
    assert "client_id_min" in str(e.value)
    ok = checked.filter("client_id > 0")
    assert cs.gate(ok, cs.rules(o, ok.columns)).count() == 3


def test_observe_rules(shop, spark):
    o = shop.object("client")
    checked = cs.rename_cast(cs.load(_client_df(spark), o, EXCL), o, EXCL)
    rl = cs.rules(o, checked.columns)
    df, obs = cs.observe_rules(checked, rl)
    df.write.format("noop").mode("overwrite").save()
    counts = {c["expectation"]: c["failed"] for c in cs.rule_counts(obs, rl)}
    assert counts["client_id_min"] == 1 and counts["mail_pattern"] == 1


def test_rule_name_dedupe():
    o = ObjectSpec.from_dict({"name": "t", "properties": [
        {"name": "a b", "logicalType": "string", "physicalType": "STRING", "required": True},
        {"name": "a_b", "logicalType": "string", "physicalType": "STRING", "required": True},
        {"name": "a.b", "logicalType": "string", "physicalType": "STRING", "required": True},
        {"name": "we`ird", "logicalType": "integer", "physicalType": "INT",
         "logicalTypeOptions": {"minimum": True, "maximum": 2.0}},
    ]})
    rl = cs.rules(o)
    assert [r.name for r in rl] == ["a_b_not_null", "a_b_not_null_2", "a_b_not_null_3", "we_ird_min", "we_ird_max"]
    assert rl[0].text == "`a b` IS NOT NULL"
    assert [r.text for r in rl][3:] == ["`we``ird` >= 1", "`we``ird` <= 2"]


def test_rename_swap(spark):
    o = ObjectSpec.from_dict({"name": "t", "properties": [
        {"name": "a", "physicalName": "b", "logicalType": "string", "physicalType": "STRING"},
        {"name": "b", "physicalName": "a", "logicalType": "integer", "physicalType": "INT"}]})
    out = cs.rename_cast(spark.createDataFrame([(1, "x")], "a int, b string"), o)
    assert out.columns == ["a", "b"] and out.first().asDict() == {"a": "x", "b": 1}


def test_struct_cast_by_name_and_map(spark):
    src = T.StructType([T.StructField("b", T.StringType()), T.StructField("a", T.StringType())])
    dst = T.StructType([T.StructField("a", T.LongType()), T.StructField("c", T.StringType())])
    df = spark.createDataFrame([(("7", "1"),), (None,)], T.StructType([T.StructField("s", src)]))
    rows = df.select(cs.cast_to(F.col("s"), src, dst).alias("s")).collect()
    assert rows[0].s.asDict() == {"a": 1, "c": None} and rows[1].s is None
    mdf = spark.createDataFrame([({"a": "5", "z": "q"},)], "m map<string,string>")
    out = mdf.select(cs.cast_to(F.col("m"), mdf.schema["m"].dataType, dst).alias("m")).first()
    assert out.m.asDict() == {"a": 5, "c": None}
    arr_src, arr_dst = T.ArrayType(src), T.ArrayType(dst)
    adf = spark.createDataFrame([([("9", "2")],)], T.StructType([T.StructField("x", arr_src)]))
    assert adf.select(cs.cast_to(F.col("x"), arr_src, arr_dst).alias("x")).first().x[0].a == 2


def test_conversions_strict_and_lenient(promo, spark):
    rows = [(1, "07/04/2024", "2024-07-01 08:00:00", "09:30:00",
             '{"segment":"s","reach":{"n":3},"extra":1}', '["a","b"]', '{"k":[1,2]}', "aGk="),
            (2, None, None, None, None, None, None, None),
            (3, "07/04/2024", "2024-01-15 08:00:00", "08:00:00", "{bad", "nope", "{}", "!!")]
    df = spark.createDataFrame(rows, "promo_id long, launch_text string, updated string, opens string, "
                                     "audience string, channels string, payload string, pixel string")
    out = cs.rename_cast(cs.convert(df, promo), promo).orderBy("promo_id").collect()
    r = out[0]
    assert r.launch == dt.date(2024, 7, 4)
    assert r.opens == dt.datetime(1970, 1, 1, 9, 30)
    assert r.audience.segment == "s" and r.audience.reach.n == 3
    assert r.channels == ["a", "b"] and r.pixel == bytearray(b"hi")
    assert json.loads(r.payload.toJson()) == {"k": [1, 2]}
    assert out[1].launch is None and out[1].audience is None
    assert out[2].audience.segment is None and out[2].channels is None  # malformed JSON: NULL fields / NULL array
    utc = cs.rename_cast(cs.convert(df, promo), promo).select(
        "promo_id", F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col("updated").cast("timestamp_ntz"))
        .alias("u")).orderBy("promo_id").collect()
    assert utc[0].u == dt.datetime(2024, 7, 1, 12, 0) and utc[2].u == dt.datetime(2024, 1, 15, 13, 0)
    bad = spark.createDataFrame([(4, "13/45/2024", "x", "x", "{}", "[]", "{", "a")], df.schema)
    with pytest.raises(Exception):
        cs.convert(bad, promo).select("launch_text").collect()
    lenient = cs.convert(bad, promo, mode="lenient").first()
    assert lenient.launch_text is None and lenient.updated is None and lenient.payload is None


def test_time_bound_uses_column_format(promo, spark):
    df = spark.createDataFrame([(1, "08:59:59"), (2, "09:00:00"), (3, "17:00:00")], "promo_id long, opens string")
    o = ObjectSpec.from_dict({"name": "p", "properties": [
        {"name": "promo_id", "logicalType": "integer", "physicalType": "BIGINT"},
        {"name": "opens", "logicalType": "time", "physicalType": "STRING",
         "logicalTypeOptions": {"format": "HH:mm:ss", "minimum": "09:00:00"}}]})
    checked = cs.rename_cast(cs.convert(df, o), o)
    s = cs.summarize(checked, cs.rules(o, checked.columns)).first()
    assert (s.expectation, s.failed) == ("opens_min", 1)


def test_excluded_column_not_converted(spark):
    o = ObjectSpec.from_dict({"name": "t", "properties": [
        {"name": "d", "logicalType": "date", "physicalType": "STRING", "logicalTypeOptions": {"format": "MM/dd/yyyy"}},
        {"name": "_om", "logicalType": "date", "physicalType": "STRING", "logicalTypeOptions": {"format": "yyyy"}}]})
    df = spark.createDataFrame([("01/02/2024", "not a year")], "d string, _om string")
    out = cs.convert(df, o, exclude={"_om"}).first()
    assert out.d == dt.date(2024, 1, 2) and out._om == "not a year"


def test_write_schema_and_frame(shop, spark):
    o = shop.object("client")
    ws = cs.write_schema(o)
    assert [f.name for f in ws.fields][-3:] == ["_ingest_file", "__START_AT", "__END_AT"]
    assert ws["client_id"].nullable is False and ws["region_id"].nullable is False and ws["mail"].nullable
    assert json.loads(ws["mail"].metadata["tags"]) == {"pii": "email", "sensitive": ""}
    assert cs.primary_key(o) == ["region_id", "client_id"]
    checked = cs.rename_cast(cs.load(_client_df(spark), o, EXCL), o, EXCL).filter("client_id > 0")
    out = cs.write_frame(checked, o, EXCL)
    assert out.columns == [f.name for f in ws.fields]
    assert out.schema["__START_AT"].dataType == T.TimestampType()
    enforced = cs.write_frame(checked, o, EXCL, enforce_not_null=True)
    assert enforced.schema["client_id"].nullable is False and enforced.schema["region_id"].nullable is False
    assert enforced.count() == 3
    nulls = checked.withColumn("region_id", F.lit(None).cast("int"))
    with pytest.raises(Exception):
        cs.write_frame(nulls, o, EXCL, enforce_not_null=True).count()


def test_key_violations(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 3), (None, 3), (2, None)], "a int, b int")
    rows = {(r.a, r.b, r.n_rows, r.violation) for r in cs.key_violations(df, ["a", "b"]).collect()}
    assert rows == {(1, 1, 2, "duplicate"), (None, 3, 2, "null_key"), (2, None, 1, "null_key")}


def test_tags(shop, spark):
    o = shop.object("client")
    assert cs.tag_map(["a:b:c", " k : v ", "flag", "a:z"]) == {"a": "z", "k": "v", "flag": ""}
    assert cs.table_tag_map(o) == {"layer": "gold", "domain": "shop", "note": "a:b", "owner": "sales",
                                   "confidential": ""}
    ct = dict(cs.column_tags(o))
    assert ct["client_id"] == {"semantic": "id"} and ct["__END_AT"] == {}
    rows = spark.createDataFrame([(1, 0, "a:1"), (1, 1, "b"), (1, 2, " a : 2 "), (2, 0, "c:d:e")],
                                 "e int, pos int, tag string")
    got = {(r.e, r.key, r.value) for r in cs.parse_tags(rows, "tag", ["e"], "pos").collect()}
    assert got == {(1, "a", "2"), (1, "b", ""), (2, "c", "d:e")}
    tagged = cs.attach_tags(_client_df(spark).withColumnRenamed("client id", "client_id"), o)
    assert json.loads(tagged.schema["client_id"].metadata["tags"]) == {"semantic": "id"}


def test_apply_contract_plan_is_one_scan(spark, tmp_path):
    from contractspark.plans import tables as tb
    from contractspark.plans.table_queries import EXCLUDE, obj

    src = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    r = cs.apply_contract(src, obj(tb.LINEITEM), EXCLUDE)
    plan = r.frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1
    assert "Exchange" not in plan
    summary_plan = r.summary()._jdf.queryExecution().executedPlan().toString()
    assert summary_plan.count("Scan parquet") == 1


def test_apply_contracts_all_or_nothing(shop, spark):
    frames = {"client": _client_df(spark).filter("`client id` > 0")}
    with pytest.raises(cs.ContractError):
        cs.apply_contracts(frames, shop, EXCL)  # no frame for "store hours": nothing is planned
    frames["store hours"] = spark.createDataFrame([("s1",)], "store string")
    res = cs.apply_contracts(frames, shop, EXCL)
    assert res["store hours"].frame.count() == 1 and res["client"].frame.count() == 3


def test_empty_input(shop, spark):
    o = shop.object("client")
    empty = _client_df(spark).limit(0)
    checked = cs.rename_cast(cs.load(empty, o, EXCL), o, EXCL)
    s = cs.summarize(checked, cs.rules(o, checked.columns)).collect()
    assert all(r.checked == 0 and r.failed == 0 for r in s)


def test_save_path_and_table(shop, spark, tmp_path):
    o = shop.object("client")
    checked = cs.rename_cast(cs.load(_client_df(spark), o, EXCL), o, EXCL).filter("client_id > 0")
    frame = cs.write_frame(checked, o, EXCL)
    out = str(tmp_path / "client")
    cs.save(frame, o, path=out)
    cs.save(frame, o, path=out)  # overwrite: rebuilt fresh, not appended
    back = spark.read.parquet(out)
    assert back.count() == 3 and back.columns == frame.columns
    with pytest.raises(ValueError):
        cs.save(frame, o)


def test_run_contracts_writes_every_object(shop, spark, tmp_path):
    frames = {"client": _client_df(spark).filter("`client id` > 0"),
              "store hours": spark.createDataFrame([("s1",), ("s2",)], "store string")}
    cs.run_contracts(frames, shop, str(tmp_path), EXCL)
    assert spark.read.parquet(str(tmp_path / "client")).count() == 3
    assert spark.read.parquet(str(tmp_path / "store hours")).count() == 2


def test_save_table_with_tags(shop, spark):
    o = shop.object("client")
    checked = cs.rename_cast(cs.load(_client_df(spark), o, EXCL), o, EXCL).filter("client_id > 0")
    cs.save(cs.write_frame(checked, o, EXCL), o, table="client_tbl")
    props = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES client_tbl").collect()}
    assert props["tag.layer"] == "gold" and props["tag.note"] == "a:b" and props["tag.confidential"] == ""
    assert spark.catalog.getTable("client_tbl").description == "Clients of the shop"
    cols = {r.col_name: r.comment for r in spark.sql("DESCRIBE TABLE client_tbl").collect()}
    assert cols["client_id"] == "Surrogate key"
    assert spark.table("client_tbl").count() == 3


def test_case_insensitive_name_clash_rejected():
    with pytest.raises(cs.ContractError) as e:
        ObjectSpec.from_dict({"name": "t", "properties": [
            {"name": "Amount", "logicalType": "number", "physicalType": "DOUBLE"},
            {"name": "amount", "logicalType": "number", "physicalType": "DOUBLE"}]})
    assert e.value.code == "ODCS-COL-001"


def test_read_as_physical_reads_text_then_casts_loudly(spark):
    o = ObjectSpec.from_dict({"name": "t", "properties": [
        {"name": "i", "logicalType": "integer", "physicalType": "STRING"}]})
    assert cs.read_schema(o, read_as="final")["i"].dataType == T.LongType()
    assert cs.read_schema(o, read_as="physical")["i"].dataType == T.StringType()
    ok = spark.createDataFrame([("12",)], "i string")
    assert cs.rename_cast(cs.load(ok, o), o).first().i == 12
    bad = spark.createDataFrame([("zz",)], "i string")
    with pytest.raises(Exception):
        cs.rename_cast(cs.load(bad, o), o).collect()
    assert cs.rename_cast(cs.load(bad, o), o, mode="lenient").first().i is None


def test_bad_temporal_bound_fails_at_plan_time():
    o = ObjectSpec.from_dict({"name": "t", "properties": [
        {"name": "d", "logicalType": "date", "physicalType": "DATE", "logicalTypeOptions": {"minimum": "not-a-date"}}]})
    with pytest.raises(cs.ContractError):
        cs.rules(o)
    ok = ObjectSpec.from_dict({"name": "t", "properties": [
        {"name": "d", "logicalType": "date", "physicalType": "DATE",
         "logicalTypeOptions": {"minimum": "2000-01-01", "maximum": "2030-12-31T00:00:00", "exclusiveMaximum": "2031"}},
        {"name": "q", "logicalType": "date", "physicalType": "DATE", "logicalTypeOptions": {"minimum": "O'Brien"}}]})
    with pytest.raises(cs.ContractError):
        cs.rules(ok)
    good = ObjectSpec.from_dict({"name": "t", "properties": [
        {"name": "d", "logicalType": "date", "physicalType": "DATE",
         "logicalTypeOptions": {"minimum": "2000-01-01", "exclusiveMaximum": "2031"}}]})
    assert [r.text for r in cs.rules(good)] == ["`d` >= '2000-01-01'", "`d` < '2031'"]


# ---- findings of the last review -------------------------------------------------------------------------------


def _contract(*objects):
    return {"version": "1", "kind": "k", "apiVersion": "v", "id": "i", "status": "s", "schema": list(objects)}


def _col(name, lt, pt, critical=False, required=False, **options):
    return {"name": name, "logicalType": lt, "physicalType": pt, "logicalTypeOptions": options, "criticalDataElement": critical, "required": required}


def test_failed_run_keeps_every_old_output(spark, tmp_path):
    from contractspark.plans.apply import run_contracts

    contract = _contract({"name": "a", "properties": [_col("x", "integer", "INT")]},
                         {"name": "b", "properties": [_col("x", "integer", "INT", critical=True, minimum=0)]})
    frame = lambda *v: spark.createDataFrame([(x,) for x in v], "x int")
    run_contracts({"a": frame(1), "b": frame(2)}, contract, str(tmp_path))
    with pytest.raises(Exception, match="rule failed"):
        run_contracts({"a": frame(3), "b": frame(-4)}, contract, str(tmp_path))
    read = lambda n: [r[0] for r in spark.read.parquet(f"{tmp_path}/{n}").collect()]
    assert read("a") == [1] and read("b") == [2] and sorted(p.name for p in tmp_path.iterdir()) == ["a", "b"]
    run_contracts({"a": frame(3), "b": frame(4)}, contract, str(tmp_path))
    assert read("a") == [3] and read("b") == [4] and sorted(p.name for p in tmp_path.iterdir()) == ["a", "b"]


def test_second_stream_run_adds_the_new_rows(spark, tmp_path):
    from contractspark.streaming.stream import run_stream

    obj = {"name": "t", "properties": [_col("x", "integer", "BIGINT")]}
    for k in (5, 7):
        spark.range(k).select(F.col("id").alias("x")).write.mode("append").parquet(f"{tmp_path}/in")
        run_stream(spark, obj, f"{tmp_path}/in", f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 12


def test_bounds_on_timestamps_with_a_format(spark):
    obj = {"name": "t", "properties": [_col("x", "timestamp", "STRING", format="MM/dd/yyyy HH:mm", minimum="2020-01-01T00:00:00", exclusiveMinimum="2019-01-01"),
                                       _col("y", "timestamp", "TIMESTAMP", format="MM/dd/yyyy", maximum="2021-01-01")]}
    df = spark.sql("SELECT '06/01/2019 10:00' x, timestamp '2020-05-05' y UNION ALL SELECT '06/01/2020 10:00', timestamp '2022-05-05'")
    res = cs.apply_contract(df, obj)
    assert [r.failed for r in res.summary().orderBy("rule_idx").collect()] == [1, 0, 1]


def test_load_matches_nested_fields_by_name_and_can_be_lenient(spark):
    from contractspark.sources.load import load

    obj = {"name": "t", "properties": [{"name": "s", "logicalType": "object", "physicalType": "STRUCT<a:STRING,b:STRING>"}, _col("n", "integer", "INT")]}
    df = spark.sql("SELECT named_struct('b', 'B', 'a', 'A') s, 'zz' n")
    row = load(df, obj, mode="lenient").first()
    assert (row.s.a, row.s.b, row.n) == ("A", "B", None)
    assert cs.apply_contract(df, obj, mode="lenient").frame.first().n is None
    twice = {"name": "t", "properties": [_col("a", "integer", "INT") | {"physicalName": "n"}, _col("b", "integer", "INT") | {"physicalName": "N"}]}
    with pytest.raises(cs.ContractError):
        load(df, twice)


def test_predicates_are_their_texts_to_the_last_digit(spark):
    obj = object_spec({"name": "t", "properties": [_col("x", "number", "DECIMAL(38,20)", maximum=0.1), _col("y", "integer", "INT", minimum=True)]})
    df = spark.sql("SELECT cast('0.10000000000000000001' AS decimal(38,20)) x, 0 y")
    assert [r.failed for r in cs.summarize(df, cs.rules(obj)).orderBy("rule_idx").collect()] == [1, 1]


def test_required_field_of_a_variant(spark):
    obj = object_spec({"name": "t", "properties": [_col("v", "object", "STRING", required=False) | {"logicalTypeOptions": {"required": ["a b"]}}]})
    df = spark.sql("""SELECT parse_json('{"a b": 1}') v UNION ALL SELECT parse_json('{"a b": null}') UNION ALL SELECT parse_json('[1]') UNION ALL SELECT null""")
    assert cs.summarize(df, cs.rules(obj)).first().failed == 2


def test_counts_of_an_aborted_job_are_not_reported(spark):
    from contractspark.operators.expect import observe_rules, rule_counts

    rl = cs.rules({"name": "t", "properties": [_col("x", "integer", "INT", critical=True, minimum=0)]})
    out, obs = observe_rules(spark.sql("SELECT -1 x"), rl)
    with pytest.raises(Exception):
        cs.gate(out, rl).collect()
    with pytest.raises(Exception):
        if rule_counts(obs, rl)[0]["checked"] == 0:
            raise AssertionError("an aborted job looks clean")


def test_tags_lose_any_white_space(spark):
    from contractspark.operators.tags import parse_tags, tag_map

    tags = ["k:\tv\n", " flag ", "a: b:c ", ":x", "\n"]
    rows = spark.createDataFrame([("e", i, t) for i, t in enumerate(tags)], "e string, pos int, tag string")
    assert {r.key: r.value for r in parse_tags(rows, "tag", ["e"], "pos").collect()} == tag_map(tags) == {"k": "v", "flag": "", "a": "b:c", "": ""}
