"""Catalog queries (R1-R8, K1-K3) over the driver's tables, registered into ``table_queries.QUERIES``.

The estate here is made from the tables themselves: every ``part`` row owns one contract column whose type
declaration comes from the type-matrix template below (``p_partkey % 61`` picks the template row; every part row is
used), ``orders``/``lineitem`` are parents and children of nested types, and part values drive rule options. The
work therefore grows with the tables.
"""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from . import catalog as cat
from .table_queries import query, table

# The type-matrix template. One row per declared column: (name, logicalType, physicalType, format,
# timezone is False, defaultTimezone, children as (name, logicalType, physicalType) or ("[]", ...) for array items).
NY = "America/New_York"
TYPE_MATRIX = [
    ("s_string", "string", "STRING", None, False, None, ()),
    ("s_char", "string", "CHAR(3)", None, False, None, ()),
    ("s_varchar", "string", "VARCHAR(20)", None, False, None, ()),
    ("s_binary", "string", "BINARY", None, False, None, ()),
    ("s_interval", "string", "INTERVAL", None, False, None, ()),
    ("s_geography", "string", "GEOGRAPHY", None, False, None, ()),
    ("s_geometry", "string", "GEOMETRY", None, False, None, ()),
    ("s_validation", "string", "STRING", "email", False, None, ()),
    ("s_base64", "string", "STRING", "byte", False, None, ()),
    ("s_unusable", "string", "NUMBER(10)", "byte", False, None, ()),
    ("i_default", "integer", "STRING", None, False, None, ()),
    ("i_i8", "integer", "STRING", "i8", False, None, ()),
    ("i_i16", "integer", "STRING", "i16", False, None, ()),
    ("i_i32", "integer", "STRING", "i32", False, None, ()),
    ("i_i64", "integer", "STRING", "i64", False, None, ()),
    ("i_u8", "integer", "STRING", "u8", False, None, ()),
    ("i_u16", "integer", "STRING", "u16", False, None, ()),
    ("i_u32", "integer", "STRING", "u32", False, None, ()),
    ("i_u64", "integer", "STRING", "u64", False, None, ()),
    ("i_i128", "integer", "STRING", "i128", False, None, ()),
    ("i_u128", "integer", "STRING", "u128", False, None, ()),
    ("i_bigint_verbatim", "integer", "BIGINT", None, False, None, ()),
    ("i_int_verbatim", "integer", "INT", None, False, None, ()),
    ("i_decimal_fallback", "integer", "DECIMAL(8,2)", None, False, None, ()),
    ("i_unusable", "integer", "NUMBER(10)", None, False, None, ()),
    ("n_default", "number", "STRING", None, False, None, ()),
    ("n_f32", "number", "STRING", "f32", False, None, ()),
    ("n_f64", "number", "STRING", "f64", False, None, ()),
    ("n_double_verbatim", "number", "DOUBLE", None, False, None, ()),
    ("n_float_verbatim", "number", "FLOAT", None, False, None, ()),
    ("n_decimal_verbatim", "number", "DECIMAL(8,2)", None, False, None, ()),
    ("n_int_verbatim", "number", "INT", None, False, None, ()),
    ("n_unusable", "number", "NUMBER(10)", None, False, None, ()),
    ("b_bool_verbatim", "boolean", "BOOLEAN", None, False, None, ()),
    ("b_string_cast", "boolean", "STRING", None, False, None, ()),
    ("b_unusable", "boolean", "NUMBER(10)", None, False, None, ()),
    ("d_date_verbatim", "date", "DATE", None, False, None, ()),
    ("d_string_no_format", "date", "STRING", None, False, None, ()),
    ("d_string_format", "date", "STRING", "MM/dd/yyyy", False, None, ()),
    ("d_unusable", "date", "NUMBER(10)", None, False, None, ()),
    ("ts_timestamp_verbatim", "timestamp", "TIMESTAMP", None, False, None, ()),
    ("ts_string_no_format", "timestamp", "STRING", None, False, None, ()),
    ("ts_string_format", "timestamp", "STRING", "yyyy-MM-dd'T'HH:mm:ss", False, None, ()),
    ("ts_string_tz", "timestamp", "STRING", "yyyy-MM-dd HH:mm:ss", True, NY, ()),
    ("ts_unusable", "timestamp", "NUMBER(10)", None, False, None, ()),
    ("t_string", "time", "STRING", "HH:mm:ss", False, None, ()),
    ("t_unusable", "time", "NUMBER(10)", None, False, None, ()),
    ("o_json_struct", "object", "STRING", None, False, None,
     (("seg", "string", "STRING"), ("sz", "integer", "INT"))),
    ("o_json_variant", "object", "STRING", None, False, None, ()),
    ("o_struct_shape", "object", "STRUCT<a:STRING>", None, False, None, (("a", "integer", "STRING"),)),
    ("o_map_shape", "object", "MAP<STRING,STRING>", None, False, None, (("a", "integer", "STRING"),)),
    ("o_map_verbatim", "object", "MAP<STRING,STRING>", None, False, None, ()),
    ("o_struct_verbatim", "object", "STRUCT<x:INT>", None, False, None, ()),
    ("o_variant_verbatim", "object", "VARIANT", None, False, None, ()),
    ("o_unusable_struct", "object", "NUMBER(10)", None, False, None, (("a", "integer", "STRING"),)),
    ("o_unusable_variant", "object", "NUMBER(10)", None, False, None, ()),
    ("a_json", "array", "STRING", None, False, None, (("[]", "string", "STRING"),)),
    ("a_items_win", "array", "ARRAY<INT>", None, False, None, (("[]", "string", "STRING"),)),
    ("a_incomplete", "array", "ARRAY", None, False, None, (("[]", "string", "STRING"),)),
    ("a_verbatim", "array", "ARRAY<INT>", None, False, None, ()),
    ("a_unusable", "array", "NUMBER(10)", None, False, None, (("[]", "string", "STRING"),)),
]

# Expected (final type, conversion) per template column, the oracle side of ``catalog_types`` and
# ``catalog_conversions``.
EXPECTED = {
    "s_string": ("STRING", None), "s_char": ("CHAR(3)", None), "s_varchar": ("VARCHAR(20)", None),
    "s_binary": ("BINARY", None), "s_interval": ("INTERVAL", None), "s_geography": ("GEOGRAPHY", None),
    "s_geometry": ("GEOMETRY", None), "s_validation": ("STRING", None), "s_base64": ("BINARY", "unbase64"),
    "s_unusable": ("STRING", None),
    "i_default": ("BIGINT", None), "i_i8": ("TINYINT", None), "i_i16": ("SMALLINT", None), "i_i32": ("INT", None),
    "i_i64": ("BIGINT", None), "i_u8": ("SMALLINT", None), "i_u16": ("INT", None), "i_u32": ("BIGINT", None),
    "i_u64": ("DECIMAL(20,0)", None), "i_i128": ("DECIMAL(38,0)", None), "i_u128": ("DECIMAL(38,0)", None),
    "i_bigint_verbatim": ("BIGINT", None), "i_int_verbatim": ("INT", None), "i_decimal_fallback": ("BIGINT", None),
    "i_unusable": ("BIGINT", None),
    "n_default": ("DOUBLE", None), "n_f32": ("FLOAT", None), "n_f64": ("DOUBLE", None),
    "n_double_verbatim": ("DOUBLE", None), "n_float_verbatim": ("FLOAT", None),
    "n_decimal_verbatim": ("DECIMAL(8,2)", None), "n_int_verbatim": ("INT", None), "n_unusable": ("DOUBLE", None),
    "b_bool_verbatim": ("BOOLEAN", None), "b_string_cast": ("BOOLEAN", None), "b_unusable": ("BOOLEAN", None),
    "d_date_verbatim": ("DATE", None), "d_string_no_format": ("DATE", None), "d_string_format": ("DATE", "to_date"),
    "d_unusable": ("DATE", None), "ts_timestamp_verbatim": ("TIMESTAMP", None),
    "ts_string_no_format": ("TIMESTAMP", None), "ts_string_format": ("TIMESTAMP", "to_timestamp"),
    "ts_string_tz": ("TIMESTAMP", "to_utc_timestamp"), "ts_unusable": ("TIMESTAMP", None),
    "t_string": ("TIMESTAMP", "to_timestamp"), "t_unusable": ("STRING", None),
    "o_json_struct": ("STRUCT<seg:STRING,sz:INT>", "from_json_struct"), "o_json_variant": ("VARIANT", "parse_json"),
    "o_struct_shape": ("STRUCT<a:BIGINT>", None), "o_map_shape": ("STRUCT<a:BIGINT>", None),
    "o_map_verbatim": ("MAP<STRING,STRING>", None), "o_struct_verbatim": ("STRUCT<x:INT>", None),
    "o_variant_verbatim": ("VARIANT", None), "o_unusable_struct": ("STRUCT<a:BIGINT>", None),
    "o_unusable_variant": ("VARIANT", None),
    "a_json": ("ARRAY<STRING>", "from_json_array"), "a_items_win": ("ARRAY<STRING>", None),
    "a_incomplete": ("ARRAY<STRING>", None), "a_verbatim": ("ARRAY<INT>", None), "a_unusable": ("ARRAY<STRING>", None),
}

# Two declarations that cannot be resolved (for ``catalog_errors``): unknown logical type, array without items.
BROKEN = [
    ("e_unknown_logical", "decimal", "NUMBER(10)", None, False, None, ()),
    ("e_array_no_items", "array", "NUMBER(10)", None, False, None, ()),
]
BROKEN_REASONS = {"e_unknown_logical": "logical type cannot be mapped: decimal",
                  "e_array_no_items": "array without items and no usable physical type"}


def _template_rows(template):
    """Catalog rows (``CATALOG_COLUMNS`` minus contract/object/path prefix) for a template, with its index."""
    rows = []
    for idx, (name, lt, pt, fmt, tz_false, tz, kids) in enumerate(template):
        opts = {}
        if fmt:
            opts["format"] = fmt
        if tz_false:
            opts["timezone"] = False
        if tz:
            opts["defaultTimezone"] = tz
        has_props = any(k[0] != "[]" for k in kids)
        has_items = any(k[0] == "[]" for k in kids)
        rows.append((idx, "", None, 0, 0, False, name, None, lt, pt, fmt, bool(fmt), tz_false, tz, json.dumps(opts),
                     has_props, has_items))
        for i, (kn, klt, kpt) in enumerate(kids):
            is_items = kn == "[]"
            rows.append((idx, "[]" if is_items else "." + kn, "", 0 if is_items else i, 1, is_items,
                         None if is_items else kn, None, klt, kpt, None, False, False, None, "{}", False, False))
    return rows


_TEMPLATE_DDL = ("idx int, path_suffix string, parent_suffix string, ordinal int, depth int, is_items boolean, "
                 "name string, physical_name string, logical_type string, physical_type string, fmt string, "
                 "fmt_truthy boolean, tz_false boolean, default_tz string, options string, has_properties boolean, "
                 "has_items boolean")


def part_catalog(spark, d, template, null_rules: bool = False):
    """One contract column per part row (object ``p<partkey>``), declared as template row ``p_partkey % n``.

    The template is a fixed, small lookup (a broadcast of at most a few hundred rows); the catalog has one row per
    part row plus its nested fields. With ``null_rules`` some declarations lose their physical type
    (``p_size % 10 = 0``) or logical type (``p_size % 7 = 0``), to exercise error rows.
    """
    tmpl = spark.createDataFrame(_template_rows(template), _TEMPLATE_DDL)
    n = len(template)
    part = table(spark, d, "part").select("p_partkey", "p_size", (F.col("p_partkey") % n).cast("int").alias("idx"))
    j = part.join(F.broadcast(tmpl), "idx")
    base = F.concat(F.lit("p"), F.col("p_partkey").cast("string"))
    pt, lt = F.col("physical_type"), F.col("logical_type")
    if null_rules:
        top = F.col("depth") == 0
        pt = F.when(top & (F.col("p_size") % 10 == 0), F.lit(None)).otherwise(pt)
        lt = F.when(top & (F.col("p_size") % 7 == 0), F.lit(None)).otherwise(lt)
    top_names = spark.createDataFrame([(i, t[0]) for i, t in enumerate(template)], "idx int, top_name string")
    j = j.join(F.broadcast(top_names), "idx")
    return j.select(
        F.lit("part").alias("contract"), base.alias("object"),
        F.concat(F.col("top_name"), F.col("path_suffix")).alias("path"),
        F.when(F.col("depth") > 0, F.col("top_name")).alias("parent_path"),
        "ordinal", "depth", "is_items", "name", "physical_name", lt.alias("logical_type"), pt.alias("physical_type"),
        "fmt", "fmt_truthy", "tz_false", "default_tz", "options",
        F.lit(False).alias("required"), F.lit(False).alias("primary_key"), F.lit(0).alias("pk_position"),
        F.lit(False).alias("critical"), F.lit(None).cast("string").alias("description"),
        F.lit(False).alias("has_description"), F.array().cast("array<string>").alias("tags"),
        "has_properties", "has_items", "p_partkey")


def _values(rows) -> str:
    def lit(v):
        return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"
    return ", ".join("(" + ", ".join(lit(v) if not isinstance(v, int) else str(v) for v in r) + ")" for r in rows)


_EXPECTED_VALUES = _values([(i, t[0], EXPECTED[t[0]][0], EXPECTED[t[0]][1]) for i, t in enumerate(TYPE_MATRIX)])
_LOAD = "CASE WHEN m.conv IS NOT NULL THEN 'STRING' ELSE m.final_type END"


@query("catalog_types",
       f"SELECT p_partkey, m.name AS column_name, m.final_type, {_LOAD} AS load_type FROM part "
       f"JOIN (VALUES {_EXPECTED_VALUES}) m(idx, name, final_type, conv) ON p_partkey % {len(TYPE_MATRIX)} = m.idx")
def catalog_types(spark, d):
    res = cat.resolve_types(part_catalog(spark, d, TYPE_MATRIX))
    return res.filter(F.col("depth") == 0).select("p_partkey", F.col("name").alias("column_name"), "final_type",
                                                  "load_type")


@query("catalog_conversions",
       f"SELECT p_partkey, m.name AS column_name, m.conv AS conversion FROM part "
       f"JOIN (VALUES {_EXPECTED_VALUES}) m(idx, name, final_type, conv) ON p_partkey % {len(TYPE_MATRIX)} = m.idx")
def catalog_conversions(spark, d):
    res = cat.resolve_types(part_catalog(spark, d, TYPE_MATRIX))
    return res.filter(F.col("depth") == 0).select("p_partkey", F.col("name").alias("column_name"), "conversion")


_ERR_TEMPLATE = TYPE_MATRIX + BROKEN
_ERR_VALUES = _values([(i, t[0], BROKEN_REASONS.get(t[0])) for i, t in enumerate(_ERR_TEMPLATE)])


@query("catalog_errors",
       f"WITH c AS (SELECT p_partkey, p_size, m.name, m.err FROM part JOIN (VALUES {_ERR_VALUES}) m(idx, name, err) "
       f"ON p_partkey % {len(_ERR_TEMPLATE)} = m.idx) "
       "SELECT p_partkey, name AS column_name, 'ODCS-TYPE-001' AS code, "
       "CASE WHEN p_size % 10 = 0 AND p_size % 7 = 0 THEN 'missing physicalType and logicalType' "
       "WHEN p_size % 10 = 0 THEN 'missing physicalType' WHEN p_size % 7 = 0 THEN 'missing logicalType' "
       "ELSE err END AS reason FROM c WHERE p_size % 10 = 0 OR p_size % 7 = 0 OR err IS NOT NULL")
def catalog_errors(spark, d):
    catalog = part_catalog(spark, d, _ERR_TEMPLATE, null_rules=True)
    res = cat.resolve_types(catalog)
    errs = cat.type_errors(res.filter(F.col("depth") == 0))
    return errs.select(F.regexp_extract("object", r"^p(\d+)$", 1).cast("long").alias("p_partkey"),
                       F.col("path").alias("column_name"), "code", "reason")


# Field type per line return flag, as (code, logicalType, physicalType, text).
FLAG_TYPES = {"A": (0, "string", "STRING"), "N": (1, "integer", "INT")}
OTHER_FLAG_TYPE = (2, "number", "DECIMAL(12,2)")


def nested_catalog(spark, d):
    """Parents = orders (one object column each), children = their line items (one field per line number).

    An (order, line) pair can repeat; it becomes one field whose type is the smallest type code of its rows
    (a hash aggregate on integers). An order without lines is an object without properties (VARIANT).
    """
    code = F.lit(OTHER_FLAG_TYPE[0])
    for flag, (c, _, _) in reversed(list(FLAG_TYPES.items())):
        code = F.when(F.col("l_returnflag") == flag, F.lit(c)).otherwise(code)
    lines = (table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min(code).alias("code")))
    by_code = {c: (lt, pt) for c, lt, pt in [*FLAG_TYPES.values(), OTHER_FLAG_TYPE]}
    lt = F.lit(None).cast("string")
    pt = F.lit(None).cast("string")
    for c, (l_, p_) in by_code.items():
        lt = F.when(F.col("code") == c, F.lit(l_)).otherwise(lt)
        pt = F.when(F.col("code") == c, F.lit(p_)).otherwise(pt)
    parent = F.col("l_orderkey").cast("string")
    kids = lines.select(
        F.lit("orders").alias("contract"), F.lit("orders").alias("object"),
        F.concat(parent, F.lit(".l"), F.col("l_linenumber").cast("string")).alias("path"),
        parent.alias("parent_path"), F.col("l_linenumber").alias("ordinal"), F.lit(1).alias("depth"),
        F.lit(False).alias("is_items"), F.concat(F.lit("l"), F.col("l_linenumber").cast("string")).alias("name"),
        lt.alias("logical_type"), pt.alias("physical_type"), F.lit(False).alias("has_properties"))
    parents = table(spark, d, "orders").select(
        F.lit("orders").alias("contract"), F.lit("orders").alias("object"),
        F.col("o_orderkey").cast("string").alias("path"), F.lit(None).cast("string").alias("parent_path"),
        F.lit(0).alias("ordinal"), F.lit(0).alias("depth"), F.lit(False).alias("is_items"),
        F.col("o_orderkey").cast("string").alias("name"), F.lit("object").alias("logical_type"),
        F.lit("NUMBER(10)").alias("physical_type"), F.lit(True).alias("has_properties"))
    common = dict(physical_name=F.lit(None).cast("string"), fmt=F.lit(None).cast("string"), fmt_truthy=F.lit(False),
                  tz_false=F.lit(False), default_tz=F.lit(None).cast("string"), options=F.lit("{}"),
                  required=F.lit(False), primary_key=F.lit(False), pk_position=F.lit(0), critical=F.lit(False),
                  description=F.lit(None).cast("string"), has_description=F.lit(False),
                  tags=F.array().cast("array<string>"), has_items=F.lit(False))
    return parents.withColumns(common).unionByName(kids.withColumns(common)).select(*cat.CATALOG_COLUMNS)


@query("catalog_nested",
       "WITH k AS (SELECT l_orderkey, l_linenumber, min(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END) "
       "AS c FROM lineitem GROUP BY 1, 2), "
       "t AS (SELECT l_orderkey, string_agg('l' || l_linenumber || ':' || CASE c WHEN 0 THEN 'STRING' "
       "WHEN 1 THEN 'INT' ELSE 'DECIMAL(12,2)' END, ',' ORDER BY l_linenumber) AS s, "
       "CAST(count(*) AS BIGINT) AS n FROM k GROUP BY 1) "
       "SELECT o_orderkey, coalesce('STRUCT<' || s || '>', 'VARIANT') AS struct_type, coalesce(n, 0) AS n_fields "
       "FROM orders LEFT JOIN t ON o_orderkey = l_orderkey")
def catalog_nested(spark, d):
    res = cat.resolve_types(nested_catalog(spark, d))
    return res.filter(F.col("depth") == 0).select(
        F.col("path").cast("long").alias("o_orderkey"), F.col("final_type").alias("struct_type"),
        F.col("n_children").cast("long").alias("n_fields"))


def rules_catalog(spark, d):
    """One column per part row in object ``p_brand``, logical type and options from the part's own values."""
    p = table(spark, d, "part")
    kind = F.col("p_partkey") % 4
    lt = F.when(kind == 0, "string").when(kind == 1, "integer").when(kind == 2, "date").otherwise("array")
    sep = F.when(F.col("p_partkey") % 2 == 0, F.lit(" x")).otherwise(F.lit(".x"))
    name = F.concat(F.lower("p_type"), sep)
    opts = (F.when(kind == 0, F.to_json(F.struct(F.col("p_size").alias("minLength"),
                                                 (F.col("p_size") + 10).alias("maxLength"),
                                                 F.concat(F.lit("^"), F.col("p_brand"), F.lit("'s\\d")).alias("pattern"))))
            .when(kind == 1, F.to_json(F.struct(F.col("p_size").alias("minimum"),
                                                F.col("p_retailprice").alias("maximum"),
                                                F.lit(1.0).alias("multipleOf"))))
            .when(kind == 2, F.to_json(F.struct(F.lit("1995-01-01").alias("minimum"),
                                                F.concat(F.lit("20"), F.lpad(F.col("p_size").cast("string"), 2, "0"),
                                                         F.lit("-12-31")).alias("exclusiveMaximum"))))
            .otherwise(F.to_json(F.struct(F.lit(1).alias("minItems"), F.col("p_size").alias("maxItems"),
                                          (F.col("p_size") % 3 == 0).alias("uniqueItems")))))
    pt = F.when(kind == 0, "STRING").when(kind == 1, "INT").when(kind == 2, "DATE").otherwise("ARRAY<STRING>")
    return p.select(
        F.lit("part").alias("contract"), F.col("p_brand").alias("object"), name.alias("path"),
        F.lit(None).cast("string").alias("parent_path"), F.col("p_partkey").cast("int").alias("ordinal"),
        F.lit(0).alias("depth"), F.lit(False).alias("is_items"), name.alias("name"),
        F.lit(None).cast("string").alias("physical_name"), lt.alias("logical_type"), pt.alias("physical_type"),
        F.lit(None).cast("string").alias("fmt"), F.lit(False).alias("fmt_truthy"), F.lit(False).alias("tz_false"),
        F.lit(None).cast("string").alias("default_tz"), opts.alias("options"),
        (F.col("p_size") % 2 == 0).alias("required"), F.lit(False).alias("primary_key"), F.lit(0).alias("pk_position"),
        (F.col("p_size") > 45).alias("critical"), F.lit(None).cast("string").alias("description"),
        F.lit(False).alias("has_description"), F.array().cast("array<string>").alias("tags"),
        F.lit(False).alias("has_properties"), F.lit(False).alias("has_items"))


_Q = "'`' || replace(nm, '`', '``') || '`'"
_S = "regexp_replace(nm, '[^A-Za-z0-9_]', '_', 'g')"
_NUM_PRICE = "regexp_replace(CAST(p_retailprice AS VARCHAR), '\\.0+$', '')"
_PAT = "'''' || replace(replace('^' || p_brand || '''s\\d', '\\', '\\\\'), '''', '''''') || ''''"


@query("catalog_expectations",
       "WITH c AS (SELECT p_partkey, p_brand, p_size, p_retailprice, lower(p_type) || CASE WHEN p_partkey % 2 = 0 "
       "THEN ' x' ELSE '.x' END AS nm, p_partkey % 4 AS k FROM part), r AS ("
       f"SELECT p_brand, nm, p_partkey, 0 AS ro, {_S} || '_not_null' AS base, {_Q} || ' IS NOT NULL' AS expression, "
       "p_size FROM c WHERE p_size % 2 = 0 UNION ALL "
       f"SELECT p_brand, nm, p_partkey, 1, {_S} || '_min_length', 'length(' || {_Q} || ') >= ' || p_size, p_size "
       "FROM c WHERE k = 0 UNION ALL "
       f"SELECT p_brand, nm, p_partkey, 2, {_S} || '_max_length', 'length(' || {_Q} || ') <= ' || (p_size + 10), "
       "p_size FROM c WHERE k = 0 UNION ALL "
       f"SELECT p_brand, nm, p_partkey, 3, {_S} || '_pattern', {_Q} || ' RLIKE ' || {_PAT}, p_size "
       "FROM c WHERE k = 0 UNION ALL "
       f"SELECT p_brand, nm, p_partkey, 4, {_S} || '_min', {_Q} || ' >= ' || p_size, p_size FROM c WHERE k = 1 "
       f"UNION ALL SELECT p_brand, nm, p_partkey, 5, {_S} || '_max', {_Q} || ' <= ' || {_NUM_PRICE}, p_size "
       "FROM c WHERE k = 1 UNION ALL "
       f"SELECT p_brand, nm, p_partkey, 8, {_S} || '_multiple_of', {_Q} || ' % 1 = 0', p_size FROM c WHERE k = 1 "
       f"UNION ALL SELECT p_brand, nm, p_partkey, 9, {_S} || '_min', {_Q} || ' >= ''1995-01-01''', p_size "
       "FROM c WHERE k = 2 UNION ALL "
       f"SELECT p_brand, nm, p_partkey, 12, {_S} || '_exclusive_max', {_Q} || ' < ''20' || lpad(CAST(p_size AS "
       "VARCHAR), 2, '0') || '-12-31''', p_size FROM c WHERE k = 2 UNION ALL "
       f"SELECT p_brand, nm, p_partkey, 13, {_S} || '_min_items', {_Q} || ' IS NULL OR (size(' || {_Q} || ') >= 1)', "
       "p_size FROM c WHERE k = 3 UNION ALL "
       f"SELECT p_brand, nm, p_partkey, 14, {_S} || '_max_items', {_Q} || ' IS NULL OR (size(' || {_Q} || ') <= ' || "
       "p_size || ')', p_size FROM c WHERE k = 3 UNION ALL "
       f"SELECT p_brand, nm, p_partkey, 15, {_S} || '_unique_items', {_Q} || ' IS NULL OR (size(' || {_Q} || ') = "
       f"size(array_distinct(' || {_Q} || ')))', p_size FROM c WHERE k = 3 AND p_size % 3 = 0) "
       "SELECT p_brand AS object, nm AS column_name, CAST(p_partkey AS INTEGER) AS column_ordinal, "
       "CAST(ro AS INTEGER) AS rule_ordinal, CASE WHEN row_number() OVER w = 1 THEN base ELSE base || '_' || "
       "row_number() OVER w END AS expectation, expression, CASE WHEN p_size > 45 THEN 'fail' ELSE 'warn' END "
       "AS action FROM r WINDOW w AS (PARTITION BY p_brand, base ORDER BY p_partkey, ro)")
def catalog_expectations(spark, d):
    return cat.expectation_catalog(rules_catalog(spark, d)).drop("contract")


_SLUG_SRC = ("CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN replace(p_name, ' ', '-') "
             "ELSE replace(p_name, ' ', '_') END")


@query("catalog_collisions",
       f"SELECT p_brand AS contract, regexp_replace({_SLUG_SRC}, '[^A-Za-z0-9_.-]', '_', 'g') AS slug, "
       f"count(*) AS n_objects, count(DISTINCT {_SLUG_SRC}) AS n_names, "
       f"CASE WHEN count(DISTINCT {_SLUG_SRC}) > 1 THEN 'collision' ELSE 'duplicate' END AS kind "
       "FROM part GROUP BY 1, 2 HAVING count(*) > 1")
def catalog_collisions(spark, d):
    p = table(spark, d, "part")
    k = F.col("p_partkey") % 3
    name = F.when(k == 0, F.col("p_name")).when(k == 1, F.regexp_replace("p_name", " ", "-")) \
        .otherwise(F.regexp_replace("p_name", " ", "_"))
    objects = p.select(F.col("p_brand").alias("contract"), name.alias("object"))
    return cat.name_collisions(objects)
