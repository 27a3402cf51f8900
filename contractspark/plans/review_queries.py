"""Queries for operators and branches that only small fixtures covered: deep types, formatted timestamps, exact bounds, VARIANT
fields, contract files decoded from rows, collisions across contracts, stage schemas, keys, NOT NULL, in-flight counts, a
whole contract written all-or-none."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from ..operators.expect import observe_rules, rule_counts, rules
from ..spec import ContractSpec, ObjectSpec
from . import catalog as cat
from . import tables as tb
from .apply import apply_contract, run_contracts
from .catalog_queries import nested_catalog
from .table_queries import CONTRACT_CUSTOMER_SQL, EXCLUDE, obj, query, staged, summary_of, summary_sql, table, work_dir

DEEP = "ARRAY<" * 12 + "INT" + ">" * 12


@query("catalog_deep",
       "WITH k AS (SELECT l_orderkey, l_linenumber, min(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END) AS c "
       "FROM lineitem GROUP BY 1, 2), t AS (SELECT l_orderkey, string_agg('l' || l_linenumber || ':' || CASE c WHEN 0 THEN "
       f"'{DEEP}' WHEN 1 THEN 'INT' ELSE 'DECIMAL(12,2)' END, ',' ORDER BY l_linenumber) AS s FROM k GROUP BY 1) "
       "SELECT o_orderkey, 'STRUCT<lines:ARRAY<' || coalesce('STRUCT<' || s || '>', 'VARIANT') || '>>' AS struct_type "
       "FROM orders LEFT JOIN t ON o_orderkey = l_orderkey")
def catalog_deep(spark, d):
    """Order → array of lines → object → fields, of which some have a type that is twelve deep."""
    flat = nested_catalog(spark, d)
    key, top = F.split("path", r"\.")[0], F.col("depth") == 0
    leaf = (flat.where(~top).withColumns({"path": F.concat(key, F.lit(".lines[]."), F.col("name")), "parent_path": F.concat(key, F.lit(".lines[]")), "depth": F.lit(3),
            "logical_type": F.when(F.col("logical_type") == "string", "array").otherwise(F.col("logical_type")),
            "physical_type": F.when(F.col("logical_type") == "string", DEEP).otherwise(F.col("physical_type"))}))
    root = flat.where(top)
    lines = root.withColumns({"path": F.concat("path", F.lit(".lines")), "parent_path": F.col("path"), "depth": F.lit(1), "name": F.lit("lines"),
                              "logical_type": F.lit("array"), "has_properties": F.lit(False), "has_items": F.lit(True)})
    item = root.withColumns({"path": F.concat("path", F.lit(".lines[]")), "parent_path": F.concat("path", F.lit(".lines")), "depth": F.lit(2),
                             "name": F.lit(None).cast("string"), "is_items": F.lit(True)})
    res = cat.resolve_types(root.unionByName(lines).unionByName(item).unionByName(leaf))
    return res.where("depth = 0").select(F.col("path").cast("long").alias("o_orderkey"), F.col("final_type").alias("struct_type"))


STAMPED = {"name": "stamped", "properties": [
    tb._p("at", "timestamp", "STRING", "at_text", options={"format": "MM/dd/yyyy HH:mm", "minimum": "1995-06-01T00:00:00", "maximum": "2000-01-01",
                                                           "exclusiveMinimum": "1996-02-03 00:00:00", "exclusiveMaximum": "1999-12-31"}),
    tb._p("native", "timestamp", "TIMESTAMP_NTZ", "o_orderdate", options={"format": "MM/dd/yyyy", "exclusiveMinimum": "1997-01-01T00:00:00"}),
    tb._p("day", "date", "STRING", "day_text", options={"format": "yyyyMMdd", "exclusiveMinimum": "1996-05-05", "exclusiveMaximum": "1998-05-05"}),
]}


@query("expect_timestamp_format_bounds", summary_sql("orders", [
    ("at_min", "warn", "o_orderdate >= TIMESTAMP '1995-06-01 00:00:00'"), ("at_max", "warn", "date_trunc('minute', o_orderdate) <= TIMESTAMP '2000-01-01 00:00:00'"),
    ("at_exclusive_min", "warn", "date_trunc('minute', o_orderdate) > TIMESTAMP '1996-02-03 00:00:00'"), ("at_exclusive_max", "warn", "o_orderdate < TIMESTAMP '1999-12-31 00:00:00'"),
    ("native_exclusive_min", "warn", "o_orderdate > TIMESTAMP '1997-01-01 00:00:00'"),
    ("day_exclusive_min", "warn", "CAST(o_orderdate AS DATE) > DATE '1996-05-05'"), ("day_exclusive_max", "warn", "CAST(o_orderdate AS DATE) < DATE '1998-05-05'")]))
def expect_timestamp_format_bounds(spark, d):
    o = ObjectSpec.from_dict(STAMPED)
    src = table(spark, d, "orders").withColumns({"at_text": F.date_format("o_orderdate", "MM/dd/yyyy HH:mm"), "day_text": F.date_format("o_orderdate", "yyyyMMdd")})
    return summary_of(staged(src, o), o)


@query("expect_decimal_bounds", summary_sql("(SELECT CAST(CAST(CAST(l_discount AS DECIMAL(4,2)) AS VARCHAR) || '00000000000000000' || (l_linenumber % 2) AS DECIMAL(38,20)) AS x FROM lineitem)", [
    ("x_max", "warn", "x <= CAST('0.05' AS DECIMAL(38,20))"), ("x_exclusive_min", "warn", "x > CAST('0.02' AS DECIMAL(38,20))")]))
def expect_decimal_bounds(spark, d):
    """Values a twentieth decimal away from the bound: compared as decimals, as the rule's text says."""
    o = ObjectSpec.from_dict({"name": "t", "properties": [tb._p("x", "number", "DECIMAL(38,20)", options={"maximum": 0.05, "exclusiveMinimum": 0.02})]})
    digits = F.concat(F.col("l_discount").cast("decimal(4,2)").cast("string"), F.lit("0" * 17), (F.col("l_linenumber") % 2).cast("string"))
    src = table(spark, d, "lineitem").select(digits.cast("decimal(38,20)").alias("x"))
    return summary_of(staged(src, o), o)


@query("expect_variant_field", summary_sql("events", [
    ("props_k_not_null", "warn", "props IS NULL OR coalesce(json_type(props, '$.k'), 'NULL') <> 'NULL'"),
    ("props_zz_not_null", "warn", "props IS NULL OR coalesce(json_type(props, '$.zz'), 'NULL') <> 'NULL'")]))
def expect_variant_field(spark, d):
    o = ObjectSpec.from_dict({"name": "t", "properties": [tb._p("props", "object", "STRING", options={"required": ["k", "zz"]})]})
    return summary_of(staged(table(spark, d, "events"), o), o)


def contract_files(spark, d):
    """A contract file (YAML text) for every part; some of them broken in one way or another."""
    head = "version: '1'\nkind: DataContract\napiVersion: v3\nid: p\nstatus: active\n"
    column = F.format_string("schema: [{name: t%d, properties: [{name: c, logicalType: string, physicalType: STRING}, {name: 'd.%d', logicalType: integer, physicalType: INT}]}]\n", F.col("p_partkey"), F.col("p_size"))
    kind = F.col("p_partkey") % 7
    text = (F.when(kind == 1, F.lit("a: [")).when(kind == 2, F.lit("- 1\n")).when(kind == 3, F.concat(F.lit(head), F.lit("schema: 5\n")))
            .when(kind == 4, F.concat(F.lit("id: x\n"), column)).when(kind == 5, F.lit("a: 1\n---\nb: 2\n")).otherwise(F.concat(F.lit(head), column)))
    prefix = F.concat(F.lit("p"), F.col("p_partkey").cast("string"))
    return table(spark, d, "part").select(F.concat(prefix, F.lit(".yaml")).alias("path"), prefix.alias("prefix"), text.alias("text"))


@query("catalog_decode",
       "SELECT p_partkey, c.column_name, c.path, c.final_type FROM part, (VALUES (0, 'STRING'), (1, 'INT')) v(i, final_type), "
       "LATERAL (SELECT CASE i WHEN 0 THEN 'c' ELSE 'd.' || p_size END AS column_name, CASE i WHEN 0 THEN 'c' ELSE 'd\\.' || p_size END AS path, v.final_type) c "
       "WHERE p_partkey % 7 IN (0, 4, 6)")
def catalog_decode(spark, d):
    res = cat.resolve_types(cat.column_catalog(cat.decode_contracts(contract_files(spark, d))))
    return res.select(F.regexp_extract("object", r"^t(\d+)$", 1).cast("long").alias("p_partkey"), F.col("name").alias("column_name"), "path", "final_type")


@query("catalog_contract_errors",
       "SELECT 'p' || p_partkey || '.yaml' AS path, CASE p_partkey % 7 WHEN 1 THEN 'ODCS-IO-002' WHEN 2 THEN 'ODCS-IO-004' WHEN 3 THEN 'ODCS-CFG-062' "
       "WHEN 4 THEN 'ODCS-CFG-062' ELSE 'ODCS-IO-003' END AS code FROM part WHERE p_partkey % 7 BETWEEN 1 AND 5")
def catalog_contract_errors(spark, d):
    return cat.contract_errors(cat.decode_contracts(contract_files(spark, d))).select("path", "code")


@query("catalog_collisions_across",
       "SELECT regexp_replace(c, '[^A-Za-z0-9_./-]', '_', 'g') AS contract, 't' AS slug, count(*) AS n_objects, count(DISTINCT c) AS n_names, "
       "CASE WHEN count(DISTINCT c) > 1 THEN 'collision' ELSE 'duplicate' END AS kind FROM (SELECT CASE WHEN p_size % 2 = 0 THEN p_brand || ' x' ELSE p_brand || '_x' END AS c "
       "FROM part) GROUP BY 1 HAVING count(*) > 1")
def catalog_collisions_across(spark, d):
    name = F.concat("p_brand", F.when(F.col("p_size") % 2 == 0, F.lit(" x")).otherwise(F.lit("_x")))
    return cat.name_collisions(table(spark, d, "part").select(name.alias("contract"), F.lit("t").alias("object")), across=True)


@query("catalog_stage_schemas",
       "SELECT o_orderkey, 'STRING' AS load_type, o_orderstatus <> 'F' AS load_nullable, 'DATE' AS transform_type, 'DATE' AS write_type, "
       "(o_orderstatus <> 'F' AND o_orderkey % 3 <> 0) AS write_nullable, CASE WHEN o_orderkey % 3 = 0 THEN 'k' || o_orderkey END AS primary_key FROM orders")
def catalog_stage_schemas(spark, d):
    """One object per order with a date column that is text in the source."""
    name = F.concat(F.lit("k"), F.col("o_orderkey").cast("string"))
    fixed = dict(contract=F.lit("c"), path=name, parent_path=F.lit(None).cast("string"), ordinal=F.lit(0), depth=F.lit(0), is_items=F.lit(False), name=name,
                 physical_name=F.lit(None).cast("string"), logical_type=F.lit("date"), physical_type=F.lit("STRING"), fmt=F.lit("yyyyMMdd"), fmt_truthy=F.lit(True),
                 tz_false=F.lit(False), default_tz=F.lit(None).cast("string"), options=F.lit('{"format": "yyyyMMdd"}'), pk_position=F.lit(1), critical=F.lit(False),
                 description=F.lit(None).cast("string"), has_description=F.lit(False), tags=F.array().cast("array<string>"), has_properties=F.lit(False), has_items=F.lit(False))
    orders = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("object"), "o_orderkey", (F.col("o_orderstatus") == "F").alias("required"),
                                              (F.col("o_orderkey") % 3 == 0).alias("primary_key")).withColumns(fixed)
    stages = cat.stage_schemas(cat.resolve_types(orders.select(*cat.CATALOG_COLUMNS)))
    keys = cat.primary_keys(orders).select("object", F.array_join("primary_key", ",").alias("primary_key"))
    return stages.join(keys, "object", "left").select(F.col("object").cast("long").alias("o_orderkey"), "load_type", "load_nullable", "transform_type", "write_type", "write_nullable", "primary_key")


@query("write_not_null", "SELECT c_custkey AS customer_id, c_name AS name, 0 AS nullable_columns FROM customer")
def write_not_null(spark, d):
    """Required and key columns come out NOT NULL; a NULL in one would end the job."""
    out = apply_contract(table(spark, d, "customer"), obj(tb.CUSTOMER, ["customer_id", "name"]), EXCLUDE, enforce_not_null=True).frame
    return out.withColumn("nullable_columns", F.lit(sum(f.nullable for f in out.schema.fields)))


@query("expect_observed", summary_sql("lineitem", [("x_min", "warn", "l_quantity >= 5"), ("x_exclusive_max", "warn", "l_quantity < 50")]))
def expect_observed(spark, d):
    """The counts collected by the action that writes the rows."""
    o = ObjectSpec.from_dict({"name": "t", "properties": [tb._p("x", "number", "DOUBLE", "l_quantity", options={"minimum": 5, "exclusiveMaximum": 50})]})
    rows = staged(table(spark, d, "lineitem"), o)
    rule_list = rules(o, rows.columns)
    watched, seen = observe_rules(rows, rule_list)
    watched.write.parquet(work_dir(spark, "expect_observed"))
    counts = [{k: r[k] for k in ("action", "checked", "failed")} | {"expectation": r["expectation"]} for r in rule_counts(seen, rule_list)]
    return spark.createDataFrame(counts, "expectation string, action string, checked long, failed long").select("expectation", "action", "checked", "failed")


@query("contracts_all", f"SELECT customer_id AS id, 'customer' AS object FROM ({CONTRACT_CUSTOMER_SQL}) UNION ALL SELECT n_nationkey, 'nation' FROM nation")
def contracts_all(spark, d):
    """A contract of two objects, run twice into one place; the second run takes the first one's place."""
    nation = {"name": "nation", "properties": [tb._p("id", "integer", "BIGINT", "n_nationkey", required=True, primaryKey=True)]}
    contract = ContractSpec.from_dict(json.loads(json.dumps({"version": "1", "kind": "k", "apiVersion": "v", "id": "i", "status": "s", "schema": [tb.CUSTOMER, nation]})))
    target = work_dir(spark, "contracts_all")
    frames = {"customer": table(spark, d, "customer").withColumn("_source_file", F.lit("customer")), "nation": table(spark, d, "nation")}
    for _ in range(2):
        run_contracts(frames, contract, target, EXCLUDE)
    return (spark.read.parquet(f"{target}/customer").select(F.col("customer_id").alias("id"), F.lit("customer").alias("object"))
            .unionByName(spark.read.parquet(f"{target}/nation").select("id", F.lit("nation").alias("object"))))
