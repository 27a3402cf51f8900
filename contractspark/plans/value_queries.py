"""Queries for values that the rules and conversions must get right (failed conversions as data, small steps, unique nested items),
and for what is written: comments, tags, files of one size."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import functions as F

from ..operators.failures import failure_counts, observe_failures, rejected
from ..operators.write import save, write_frame
from ..spec import ObjectSpec
from . import catalog as cat
from . import tables as tb
from .table_queries import query, staged, summary_of, summary_sql, table, work_dir

MIXED = {"name": "mixed", "properties": [
    tb._p("order_id", "integer", "BIGINT", "o_orderkey"),
    tb._p("day", "date", "STRING", options={"format": "yyyyMMdd"}),
    tb._p("at", "timestamp", "STRING", options={"format": "MM/dd/yyyy HH:mm"}),
    tb._p("utc", "timestamp", "STRING", options={"format": "yyyy-MM-dd HH:mm", "timezone": False, "defaultTimezone": "Europe/Paris"}),
    {"name": "props", "logicalType": "object", "physicalType": "STRING", "properties": [tb._p("k", "integer", "BIGINT"), tb._p("j", "string", "STRING")]},
    {"name": "sizes", "logicalType": "array", "physicalType": "STRING", "items": tb._p("x", "integer", "INT")},
    tb._p("doc", "object", "STRING"),
    tb._p("raw", "string", "STRING", options={"format": "byte"}),
    tb._p("n", "integer", "STRING"),
]}


def mixed_rows(spark, d):
    """Orders as text columns; of each column another share is broken, in whole or in part."""
    k = F.col("o_orderkey")
    text = k.cast("string")
    of = lambda m, bad, good: F.when(k % m == 0, F.lit(bad)).otherwise(good)
    return table(spark, d, "orders").select(
        "o_orderkey", of(7, "19990230", F.date_format("o_orderdate", "yyyyMMdd")).alias("day"), of(11, "13/01/1999 00:00", F.date_format("o_orderdate", "MM/dd/yyyy HH:mm")).alias("at"),
        of(5, "soon", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm")).alias("utc"),
        F.when(k % 6 == 0, '{"k": ').when(k % 6 == 1, '{"k": "x", "j": "y"}').when(k % 6 == 2, F.lit("null")).when(k % 6 == 3, F.lit(None)).otherwise(F.concat(F.lit('{"k": '), text, F.lit("}"))).alias("props"),
        F.when(k % 8 == 0, '[1, "two"]').when(k % 8 == 1, "[1").when(k % 8 == 2, "[]").otherwise(F.concat(F.lit("[1, "), text, F.lit("]"))).alias("sizes"),
        of(9, '{"a"', F.concat(F.lit('{"a": '), text, F.lit("}"))).alias("doc"), of(4, "***", F.base64(text.cast("binary"))).alias("raw"), of(3, "few", text).alias("n"))


_SHARES = [("day", "o_orderkey % 7 = 0"), ("at", "o_orderkey % 11 = 0"), ("utc", "o_orderkey % 5 = 0"), ("props", "o_orderkey % 6 IN (0, 1)"),
           ("sizes", "o_orderkey % 8 IN (0, 1)"), ("doc", "o_orderkey % 9 = 0"), ("raw", "o_orderkey % 4 = 0"), ("n", "o_orderkey % 3 = 0")]


@query("convert_failures", " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) AS checked, count(*) FILTER (WHERE {w}) AS failed FROM orders" for c, w in _SHARES))
def convert_failures(spark, d):
    return failure_counts(mixed_rows(spark, d), ObjectSpec.from_dict(MIXED))


@query("convert_failures_observed", " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {w}) AS failed FROM orders" for c, w in _SHARES))
def convert_failures_observed(spark, d):
    """The counts come with the action that writes the rows."""
    rows, counts = observe_failures(mixed_rows(spark, d), ObjectSpec.from_dict(MIXED))
    rows.write.parquet(work_dir(spark, "convert_failures"))
    return spark.createDataFrame(list(counts().items()), "column string, failed long")


@query("convert_rejected", "SELECT * FROM (" + " UNION ALL ".join(f"SELECT o_orderkey, '{c}' AS \"column\" FROM orders WHERE {w}" for c, w in _SHARES) + ")")
def convert_rejected(spark, d):
    out = rejected(mixed_rows(spark, d), ObjectSpec.from_dict(MIXED))
    return out.select("o_orderkey", F.explode("_failed").alias("f")).select("o_orderkey", "f.column")


_STEPS = ("(SELECT CAST(l_linenumber AS DECIMAL(20,8)) * CAST('0.00001' AS DECIMAL(20,8)) + CASE WHEN l_orderkey % 3 = 0 THEN CAST('0.000005' AS DECIMAL(20,8)) ELSE 0 END AS x FROM lineitem)")


@query("expect_small_steps", summary_sql(_STEPS, [("x_min", "warn", "x >= CAST('0.00002' AS DECIMAL(20,8))"), ("x_exclusive_max", "warn", "x < CAST('0.00007' AS DECIMAL(20,8))"),
                                                  ("x_multiple_of", "warn", "x % CAST('0.00001' AS DECIMAL(20,8)) = 0")]))
def expect_small_steps(spark, d):
    """Bounds and steps whose text has an exponent, compared as decimals."""
    o = ObjectSpec.from_dict({"name": "t", "properties": [tb._p("x", "number", "DECIMAL(20,8)", options={"multipleOf": 0.00001, "minimum": 2e-05, "exclusiveMaximum": 7e-05})]})
    half = F.when(F.col("l_orderkey") % 3 == 0, F.lit("0.000005").cast("decimal(20,8)")).otherwise(F.lit(0).cast("decimal(20,8)"))
    x = (F.col("l_linenumber").cast("decimal(10,0)") * F.lit("0.00001").cast("decimal(10,8)") + half).cast("decimal(20,8)")
    return summary_of(staged(table(spark, d, "lineitem").select(x.alias("x")), o), o)


NESTED = {"name": "nested", "properties": [
    {"name": "docs", "logicalType": "array", "physicalType": "STRING", "logicalTypeOptions": {"uniqueItems": True}, "items": tb._p("x", "object", "VARIANT")},
    {"name": "maps", "logicalType": "array", "physicalType": "ARRAY<MAP<STRING,INT>>", "logicalTypeOptions": {"uniqueItems": True}},
]}


@query("expect_unique_items_nested", summary_sql("(SELECT * FROM lineitem)", [
    ("docs_unique_items", "warn", "l_linenumber <> l_suppkey % 8 AND l_linenumber <> 7"), ("maps_unique_items", "warn", "l_linenumber <> l_partkey % 8")]))
def expect_unique_items_nested(spark, d):
    """Items that are variants or maps: equal whatever the order of their keys and the form of their numbers."""
    n, s, p = (F.col(c).cast("string") for c in ("l_linenumber", "l_suppkey", "l_partkey"))
    rows = table(spark, d, "lineitem")
    first = F.concat(F.lit('{"a": '), n, F.lit(', "b": ["x", {"c": 1, "d": "1.0"}]}'))
    second = F.concat(F.lit('{"b": ["x", {"d": "1.0", "c": 1.0}], "a": '), (F.col("l_suppkey") % 8).cast("string"), F.lit(".00}"))
    third = F.concat(F.lit('{"a": 7e0, "b": ["x", {"c": 1, "d": "1.0"}]}'))
    other = F.lit('{"a": 1, "b": ["x", {"c": 1, "d": "1"}]}')  # a text that differs
    docs = F.concat(F.lit("["), F.concat_ws(", ", first, F.when(F.col("l_suppkey") % 8 != 7, second), third, other), F.lit("]"))
    pair = lambda a, b: F.map_from_arrays(F.array(F.lit(a), F.lit(b)), F.array(F.col("l_linenumber").cast("int"), F.lit(2)))
    mod = (F.col("l_partkey") % 8).cast("int")
    maps = F.array(pair("k", "z"), F.map_from_arrays(F.array(F.lit("z"), F.lit("k")), F.array(F.lit(2), mod)))
    o = ObjectSpec.from_dict(NESTED)
    return summary_of(staged(rows.select(docs.alias("docs"), maps.alias("maps")), o), o)


def _described(spark, d):
    """A contract object of a column per nation: its comment is the nation's, its tags the region's."""
    rows = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).orderBy("n_nationkey").collect()  # a contract: one row a column
    return ObjectSpec.from_dict({"name": "t", "description": "of nations", "tags": [f"n:{len(rows)}"], "properties": [
        {"name": f"c{r.n_nationkey}", "logicalType": "integer", "physicalType": "BIGINT", "description": r.n_name, "tags": [f"region:{r.r_name}", "word"]} for r in rows]})


@query("write_comments", "SELECT 'c' || n_nationkey AS column_name, n_name AS comment FROM nation")
def write_comments(spark, d):
    """Comments of the columns as the catalog has them after a write."""
    o = _described(spark, d)
    rows = table(spark, d, "customer").select(*[F.col("c_custkey").alias(c.name) for c in o.columns])
    name = "w5_" + uuid.uuid4().hex
    try:
        save(write_frame(rows, o), o, table=name)
        found = [(r.col_name, r.comment) for r in spark.sql(f"DESCRIBE TABLE {name}").collect()]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return spark.createDataFrame(found, "column_name string, comment string")


@query("tags_attached", "SELECT 'c' || n_nationkey AS column_name, 'region' AS key, r_name AS value FROM nation JOIN region ON n_regionkey = r_regionkey "
       "UNION ALL SELECT 'c' || n_nationkey, 'word', '' FROM nation UNION ALL SELECT NULL, 'n', CAST(count(*) AS VARCHAR) FROM nation")
def tags_attached(spark, d):
    """Column tags in the written files' schema, table tags as the table's properties."""
    o = _described(spark, d)
    rows = table(spark, d, "customer").select(*[F.col("c_custkey").alias(c.name) for c in o.columns])
    name = "g4_" + uuid.uuid4().hex
    try:
        save(write_frame(rows, o), o, table=name)
        found = [(f.name, k, v) for f in spark.table(name).schema.fields for k, v in json.loads(f.metadata["tags"]).items()]
        found += [(None, r.key[4:], r.value) for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect() if r.key.startswith("tag.")]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return spark.createDataFrame(found, "column_name string, key string, value string")


@query("write_sized", "SELECT l_returnflag, l_orderkey, l_linenumber, l_extendedprice FROM lineitem")
def write_sized(spark, d):
    """Lineitem partitioned by flag, written to files of about 256 KB and read back."""
    folder = work_dir(spark, "write_sized")
    o = ObjectSpec.from_dict({"name": "t", "properties": [tb._p("l_returnflag", "string", "STRING"), tb._p("l_orderkey", "integer", "BIGINT"),
                                                          tb._p("l_linenumber", "integer", "BIGINT"), tb._p("l_extendedprice", "number", "DOUBLE")]})
    save(write_frame(table(spark, d, "lineitem"), o), o, path=folder, partition_by=["l_returnflag"], file_bytes=256 << 10)
    return spark.read.parquet(folder).select("l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice")


_BRAND = "CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER)"


@query("catalog_scan",
       f"SELECT DISTINCT (CASE WHEN p_size % 5 = 0 THEN '_' ELSE '' END) || 'b' || (p_size % 3) || '/' || (CASE WHEN {_BRAND} % 4 = 0 THEN '.' ELSE '' END) || 'p' || {_BRAND} || 'x' || p_size AS prefix, "
       "p_size % 7 = 0 AS is_fault, p_size % 7 <> 0 AS has_text FROM part")
def catalog_scan(spark, d):
    """L4: a contract file for every brand and size, written by tasks: some in hidden folders, some with hidden names, some not
    UTF-8; then scanned."""
    folder = work_dir(spark, "catalog_scan")
    brand, size = F.regexp_extract("p_brand", "([0-9]+)", 1).cast("int"), F.col("p_size").cast("int")
    hidden = lambda c, mark: F.when(c, F.lit(mark)).otherwise(F.lit(""))
    name = F.concat(hidden(size % 5 == 0, "_"), F.lit("b"), (size % 3).cast("string"), F.lit("/"), hidden(brand % 4 == 0, "."), F.lit("p"), brand.cast("string"), F.lit("x"), size.cast("string"))
    text = F.concat(F.lit("id: x\n# "), F.col("p_brand"), F.lit("\n"))
    rows = table(spark, d, "part").select(name.alias("prefix"), F.concat(text.cast("binary"), F.when(size % 7 == 0, F.lit(b"caf\xe9")).otherwise(F.lit(b""))).alias("content")).distinct()

    def written(batches):
        from pyarrow import fs as files

        for batch in batches:
            for prefix, content in zip(*(c.to_pylist() for c in batch.columns)):
                where, name = (files.LocalFileSystem(), folder.removeprefix("file:")) if "://" not in folder.removeprefix("file://") else files.FileSystem.from_uri(folder)
                path = f"{name.replace('//', '/')}/{prefix}.yaml"
                where.create_dir(path.rpartition("/")[0])
                with where.open_output_stream(path) as f:
                    f.write(content)
            yield batch.select(["prefix"])

    rows.mapInArrow(written, "prefix string").count()
    return cat.scan_contracts(spark, folder).select("prefix", F.col("fault").isNotNull().alias("is_fault"), F.col("text").isNotNull().alias("has_text"))
