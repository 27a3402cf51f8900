"""Contract files as tables (L4/L5) and the set-based catalog jobs (R1-R8, K1-K3) against the driver-side rules."""

import pytest
from pyspark.sql import functions as F

import contractspark as cs
from contractspark.plans import catalog as cat
from contractspark.spec import ContractSpec, object_spec

from .conftest import CONTRACTS


@pytest.fixture(scope="module")
def decoded(spark):
    return cat.decode_contracts(cat.scan_contracts(spark, CONTRACTS)).cache()


def test_scan_contracts(spark):
    rows = cat.scan_contracts(spark, CONTRACTS).collect()
    assert sorted(r.prefix for r in rows) == ["a_list", "broken", "empty", "marketing/promo", "shop.contract", "two_docs"]
    assert cat.scan_contracts(spark, CONTRACTS + "/missing").count() == 0


def test_contract_errors(decoded):
    errs = {(r.path.rsplit("/", 1)[-1], r.code) for r in cat.contract_errors(decoded).collect()}
    assert errs == {("a_list.yml", "ODCS-IO-004"), ("empty.yaml", "ODCS-IO-003"), ("two_docs.yaml", "ODCS-IO-003"),
                    ("broken.yaml", "ODCS-CFG-062")}


def test_driver_side_contract_errors():
    with pytest.raises(cs.ContractError) as e:
        ContractSpec.from_yaml(open(f"{CONTRACTS}/two_docs.yaml").read())
    assert e.value.code == "ODCS-IO-003"
    with pytest.raises(cs.ContractError) as e:
        ContractSpec.from_yaml(open(f"{CONTRACTS}/broken.yaml").read())
    assert e.value.code == "ODCS-CFG-062"
    with pytest.raises(cs.ContractError) as e:
        ContractSpec.from_dict({"version": "1", "kind": "k", "apiVersion": "v", "id": "i", "status": "s",
                                "schema": [{"name": "a"}, {"name": "a"}]})
    assert e.value.code == "ODCS-OBJ-001"


def test_catalog_resolution_matches_driver(spark, decoded):
    catalog = cat.column_catalog(decoded).cache()
    res = cat.resolve_types(catalog)
    got = {(r.contract, r.object, r.name): (r.final_type, r.conversion, r.load_type)
           for r in res.filter("depth = 0").collect()}
    for prefix, fname in (("shop.contract", "shop.contract.yaml"), ("marketing/promo", "marketing/promo.yml")):
        spec = ContractSpec.from_yaml(open(f"{CONTRACTS}/{fname}").read())
        for o in spec.objects:
            for p in cs.plan_columns(o):
                assert got[(prefix, o.name, p.name)] == (p.final.text, p.conversion, p.load.text), p.name
    nested = {r.path: r.type_text for r in res.filter("contract = 'marketing/promo'").collect()}
    assert nested["audience"] == "STRUCT<segment:STRING,reach:STRUCT<n:INT>>"
    assert nested["channels"] == "ARRAY<STRING>"
    errors = {(r.path, r.reason) for r in cat.type_errors(res).collect()}
    assert errors == {("a", "missing logicalType"), ("b", "logical type cannot be mapped: decimal")}


def test_expectation_catalog_matches_driver(spark, decoded):
    catalog = cat.column_catalog(decoded)
    got = {}
    for r in cat.expectation_catalog(catalog).collect():
        got.setdefault((r.contract, r.object), []).append((r.column_ordinal, r.rule_ordinal, r.expectation,
                                                           r.expression, r.action))
    for prefix, fname in (("shop.contract", "shop.contract.yaml"), ("marketing/promo", "marketing/promo.yml")):
        spec = ContractSpec.from_yaml(open(f"{CONTRACTS}/{fname}").read())
        for o in spec.objects:
            want = [(r.name, r.text, r.action) for r in cs.rules(o)]
            have = [(e, x, a) for _, _, e, x, a in sorted(got.get((prefix, o.name), []))]
            assert have == want


def test_stage_schemas_keys_tags_collisions(spark, decoded):
    catalog = cat.column_catalog(decoded)
    res = cat.resolve_types(catalog)
    st = {r.name: r for r in cat.stage_schemas(res, cs.exclusion_set({"_ingest_file"}))
          .filter("contract = 'shop.contract'").collect()}
    assert st["client_id"].load_name == "client id" and st["client_id"].write_nullable is False
    assert st["client_id"].load_nullable is False and st["mail"].load_type == "VARCHAR(100)"
    assert st["_ingest_file"].load_name is None and st["_ingest_file"].write_type == "STRING"
    pk = {r.object: r.primary_key for r in cat.primary_keys(catalog).collect()}
    assert pk["client"] == ["region_id", "client_id"] and pk["promo"] == ["promo_id"]
    objs = cat.object_catalog(decoded)
    tags = {(r.object, r.key): r.value for r in cat.table_tags(objs).collect()}
    assert tags[("client", "layer")] == "gold" and tags[("client", "note")] == "a:b"
    assert tags[("store hours", "domain")] == "shop"
    names = spark.createDataFrame([("c", "a b"), ("c", "a_b"), ("c", "x"), ("c", "x"), ("d", "a b")],
                                  "contract string, object string")
    got = {(r.contract, r.slug, r.kind) for r in cat.name_collisions(names).collect()}
    assert got == {("c", "a_b", "collision"), ("c", "x", "duplicate")}


HEAD = "version: '1'\nkind: k\napiVersion: v\nid: i\nstatus: s\n"


def test_scan_takes_hidden_names_and_odd_folders(spark, tmp_path, monkeypatch):
    root = tmp_path / "my contracts"
    (root / "_in").mkdir(parents=True)
    for name in ("_draft.yaml", ".hid.yaml", "plain one.yml", "_in/b.yaml"):
        (root / name).write_text(HEAD)
    want = ["_draft", ".hid", "plain one", "_in/b"]
    assert sorted(r.prefix for r in cat.scan_contracts(spark, str(root)).collect()) == sorted(want)
    (root / "_in" / "deep" / ".x" / "y").mkdir(parents=True)
    (root / "_in" / "deep" / ".x" / "y" / "c.yaml").write_text(HEAD)
    (root / "_in" / "deep" / "_d.yml").write_text(HEAD)
    want += ["_in/deep/.x/y/c", "_in/deep/_d"]
    scanned = cat.scan_contracts(spark, str(root)).collect()
    assert sorted(r.prefix for r in scanned) == sorted(want) and {r.text for r in scanned} == {HEAD} and {r.fault for r in scanned} == {None}
    assert sorted(r.prefix for r in cat.scan_contracts(spark, f"file://{str(root).replace(' ', '%20')}").collect() or []) in (sorted(want), [])


def test_a_bad_contract_is_a_row_and_the_others_resolve(spark):
    texts = {"position": HEAD + "schema: [{name: t, properties: [{name: a, primaryKeyPosition: first}]}]", "schema": HEAD + "schema: 5",
             "tags": HEAD + "tags: 7", "yaml": "a: [", "good": HEAD + "schema: [{name: t, properties: [{name: a, logicalType: string, physicalType: STRING}]}]"}
    decoded = cat.decode_contracts(spark.createDataFrame([(f"{k}.yaml", k, t) for k, t in texts.items()], "path string, prefix string, text string"))
    errors = {r.path: r.code for r in cat.contract_errors(decoded).collect()}
    assert errors == {"position.yaml": "ODCS-CFG-062", "schema.yaml": "ODCS-CFG-062", "tags.yaml": "ODCS-CFG-062", "yaml.yaml": "ODCS-IO-002"}
    assert [(r.contract, r.final_type) for r in cat.resolve_types(cat.column_catalog(decoded)).collect()] == [("good", "STRING")]


def _nested(depth):
    p = {"name": "leaf", "logicalType": "integer", "physicalType": "INT"}
    for k in range(depth):
        p = {"name": f"s{k}", "logicalType": "object", "physicalType": "STRING", "properties": [p]}
    return p


def test_any_depth_resolves_in_one_scan_and_names_with_dots_stay_apart(spark):
    import json

    obj = {"name": "t", "properties": [
        _nested(6), {"name": "a", "logicalType": "object", "physicalType": "STRING", "properties": [{"name": "b.c", "logicalType": "object", "physicalType": "STRING", "properties": [{"name": "p", "logicalType": "string", "physicalType": "STRING"}]}]},
        {"name": "a.b", "logicalType": "object", "physicalType": "STRING", "properties": [{"name": "c", "logicalType": "object", "physicalType": "STRING", "properties": [{"name": "q", "logicalType": "string", "physicalType": "STRING"}]}]}]}
    text = HEAD + "schema: [" + json.dumps(obj) + "]"
    decoded = cat.decode_contracts(spark.createDataFrame([("x.yaml", "x", text)], "path string, prefix string, text string"))
    res = cat.resolve_types(cat.column_catalog(decoded))
    got = {r.name: r.final_type for r in res.filter("depth = 0").collect()}
    assert got == {p.name: p.final.text for p in cs.plan_columns(object_spec(obj))}
    assert got["a"] == "STRUCT<b.c:STRUCT<p:STRING>>"
    plan = res._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 1 and "Join" not in plan


def test_estate_rules_are_those_of_one_spec(spark):
    import json

    opts = [("integer", {"minimum": 1.5e20, "maximum": True, "custom": {"minimum": 3}}), ("number", {"multipleOf": 1.5e-05, "exclusiveMaximum": 2.0}),
            ("string", {"custom": {"minLength": 3}, "pattern": "it's\\d"}), ("array", {"uniqueItems": "true", "minItems": 2}), ("object", {"required": ["a`b", "c"]})]
    obj = {"name": "t", "properties": [{"name": f"x {k}", "logicalType": lt, "physicalType": "STRING", "logicalTypeOptions": o} for k, (lt, o) in enumerate(opts)]}
    text = HEAD + "schema: [" + json.dumps(obj) + "]"
    decoded = cat.decode_contracts(spark.createDataFrame([("x.yaml", "x", text)], "path string, prefix string, text string"))
    got = sorted((r.column_ordinal, r.rule_ordinal, r.expectation, r.expression) for r in cat.expectation_catalog(cat.column_catalog(decoded)).collect())
    from contractspark.operators.expect import column_rules

    want = [(base, text) for c in object_spec(obj).columns for base, _, text, _ in column_rules(c)]
    assert [(e, x) for _, _, e, x in got if "unique" not in e] == want


def test_collisions_across_contracts(spark):
    names = spark.createDataFrame([("a b", "t"), ("a_b", "t"), ("c", "u")], "contract string, object string")
    assert cat.name_collisions(names).count() == 0
    assert [(r.contract, r.slug, r.kind) for r in cat.name_collisions(names, across=True).collect()] == [("a_b", "t", "collision")]


def test_a_file_that_is_not_utf8_is_an_error_row(spark, tmp_path):
    (tmp_path / "latin.yaml").write_bytes((HEAD + "name: caf\xe9\n").encode("latin-1"))
    (tmp_path / "_latin.yaml").write_bytes((HEAD + "name: caf\xe9\n").encode("latin-1"))
    (tmp_path / "bom.yaml").write_bytes((HEAD + "schema: [{name: t, properties: [{name: caf\u00e9, logicalType: string, physicalType: STRING}]}]").encode("utf-8-sig"))
    decoded = cat.decode_contracts(cat.scan_contracts(spark, str(tmp_path)))
    assert sorted((r.path.rsplit("/", 1)[-1], r.code) for r in cat.contract_errors(decoded).collect()) == [("_latin.yaml", "ODCS-IO-001"), ("latin.yaml", "ODCS-IO-001")]
    assert [r.name for r in cat.column_catalog(decoded).collect()] == ["caf\u00e9"]


def test_only_changed_files_are_decoded(spark, tmp_path):
    root, store = tmp_path / "contracts", str(tmp_path / "store")
    root.mkdir()
    text = lambda k, t: HEAD + f"schema: [{{name: t{k}, properties: [{{name: a, logicalType: string, physicalType: {t}}}]}}]"
    for k in range(1000):
        (root / f"c{k}.yaml").write_text(text(k, "STRING"))
    rows = lambda df: sorted(map(str, df.collect()))
    full = lambda: cat.decode_contracts(cat.scan_contracts(spark, str(root)))
    assert cat.refresh_decoded(spark, str(root), store) == {"decoded": 1000, "kept": 0, "removed": 0}
    (root / "c7.yaml").write_text(text(7, "INT"))
    assert cat.refresh_decoded(spark, str(root), store) == {"decoded": 1, "kept": 999, "removed": 1}
    assert rows(spark.read.parquet(store).select(*full().columns)) == rows(full())
    (root / "c8.yaml").unlink()
    (root / "c9.yaml").rename(root / "_c9.yaml")
    assert cat.refresh_decoded(spark, str(root), store) == {"decoded": 1, "kept": 998, "removed": 2}
    assert rows(spark.read.parquet(store).select(*full().columns)) == rows(full())
    assert cat.refresh_decoded(spark, str(root), store) == {"decoded": 0, "kept": 999, "removed": 0}


def test_wide_structs_assemble(spark):
    import json

    obj = {"name": "t", "properties": [{"name": "w", "logicalType": "object", "physicalType": "STRING", "properties": [{"name": f"c{k}", "logicalType": "integer", "physicalType": "INT"} for k in range(2000)]}]}
    decoded = cat.decode_contracts(spark.createDataFrame([("x.yaml", "x", HEAD + "schema: [" + json.dumps(obj) + "]")], "path string, prefix string, text string"))
    got = {r.path: (r.type_text, r.n_children) for r in cat.resolve_types(cat.column_catalog(decoded)).collect()}
    assert got["w"] == ("STRUCT<" + ",".join(f"c{k}:INT" for k in range(2000)) + ">", 2000) and len(got) == 2001


def test_rows_are_hashed_only_where_paths_repeat(spark):
    lead = ("k", "o", "a", None, 0, 0, False, "a", "object", "STRING", True)
    kids = [("k", "o", f"a.{n}", "a", i, 1, False, n, "integer", t, False) for i, (n, t) in enumerate((("x", "INT"), ("y", "BIGINT")))]
    ddl = "contract string, object string, path string, parent_path string, ordinal int, depth int, is_items boolean, name string, logical_type string, physical_type string, has_properties boolean"
    rest = {c: F.lit(None).cast(t) for c, t in (x.strip().split(" ", 1) for x in cat.CATALOG_DDL.split(",")) if c not in ddl.replace(",", "").split(" ")}
    frame = lambda rows: spark.createDataFrame(rows, ddl).withColumns({**rest, "has_items": F.lit(False)}).select(*cat.CATALOG_COLUMNS)
    res = cat.resolve_types(frame([lead, *kids]))
    assert [r.type_text for r in res.where("depth = 0").collect()] == ["STRUCT<x:INT,y:BIGINT>"]
    twice = cat.resolve_types(frame([lead, *kids, lead])).where("depth = 0").collect()
    assert len(twice) == 2 and sorted(r.n_children for r in twice) == [0, 2]
    plan = res._jdf.queryExecution().optimizedPlan().toString()  # a group's rows are collected without a JSON text of each
    assert "StructsToJson" not in next(line for line in plan.splitlines() if "collect_list" in line)
