"""The registered queries: each one applies contract operators to the driver's tables (whole tables).

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name]`` (DuckDB SQL over the same tables) come in pairs;
the column names are the same on both sides. Outputs are flat: structs are exposed field by field, binaries as hex,
zoned timestamps as UTC wall clocks (``timestamp_ntz``), decimals as doubles.
"""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cast import rename_cast
from ..operators.convert import convert
from ..operators.expect import annotate, gate, rules, summarize
from ..operators.tags import merge_tags, parse_tags, tag_key, tag_value, tags_per_entity
from ..operators.write import key_violations, primary_key, write_frame
from ..sources.load import load
from ..spec import ObjectSpec, exclusion_set
from ..streaming.stream import shared_dir
from . import tables as tb
from .apply import apply_contract

QUERIES: dict = {}
ORACLE: dict = {}
EXCLUDE = exclusion_set(tb.OPERATIONAL)


def query(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def work_dir(spark: SparkSession, *parts: str) -> str:
    """A new folder for a query's own writes, under ``spark.checkpoint.dir``; a local session without one gets one."""
    one_machine = re.match(r"local(\[|$)", spark.sparkContext.master)
    if one_machine and not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="contractspark-"))
    return shared_dir(spark, *parts)


def obj(d: dict, keep=None, **override) -> ObjectSpec:
    """An object of ``d`` with only the named columns (in the given order) and ``override`` column options."""
    props = d["properties"]
    if keep is not None:
        by = {p["name"]: p for p in props}
        props = [by[k] for k in keep]
    props = [dict(p, logicalTypeOptions=override[p["name"]]) if p["name"] in override else p for p in props]
    return ObjectSpec.from_dict(dict(d, properties=props))


def staged(df: DataFrame, o: ObjectSpec, mode: str = "strict") -> DataFrame:
    """load → convert → rename/cast: the checked frame rules run on."""
    return rename_cast(convert(load(df, o, EXCLUDE), o, EXCLUDE, mode=mode), o, EXCLUDE, mode=mode)


def utc_wall(c):
    """An instant as its UTC wall clock (``timestamp_ntz``), whatever the session time zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), c.cast("timestamp_ntz"))


def summary_of(df: DataFrame, o: ObjectSpec, object_name: str | None = None) -> DataFrame:
    out = summarize(df, rules(o, df.columns)).select("expectation", "action", "checked", "failed")
    return out.withColumn("object_name", F.lit(object_name or o.name)) if object_name else out


def _union_sql(parts):
    return "\nUNION ALL\n".join(parts)


def summary_sql(table_sql: str, checks, object_name: str | None = None) -> str:
    """DuckDB: one ``SELECT`` per rule → (expectation, action, checked, failed) [+ object_name]."""
    extra = f", '{object_name}' AS object_name" if object_name else ""
    return _union_sql([
        f"SELECT '{n}' AS expectation, '{a}' AS action, CAST(count(*) AS BIGINT) AS checked, "
        f"CAST(sum(CASE WHEN NOT coalesce(({p}), true) THEN 1 ELSE 0 END) AS BIGINT) AS failed{extra} "
        f"FROM {table_sql}"
        for n, a, p in checks])


# ---------------------------------------------------------------- L2 / T1-T5 --------------------------------------


@query("load_projection",
       "SELECT o_orderdate, o_orderkey, o_totalprice, o_orderpriority FROM orders")
def load_projection(spark, d):
    return load(table(spark, d, "orders"), obj(tb.ORDERS, ["order_ts", "order_id", "total", "o_orderpriority"]),
                EXCLUDE)


@query("rename_cast",
       "SELECT c_custkey AS customer_id, c_name AS name, c_nationkey AS nation_id, "
       "CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS DOUBLE) AS balance, c_mktsegment AS segment FROM customer")
def q_rename_cast(spark, d):
    o = obj(tb.CUSTOMER, ["customer_id", "name", "nation_id", "balance", "segment"])
    out = staged(table(spark, d, "customer"), o)
    return out.withColumn("balance", F.col("balance").cast("double"))


NATION_SWAP = {"name": "nation", "properties": [
    tb._p("n_nationkey", "integer", "INT"),
    tb._p("n_name", "integer", "INT", "n_regionkey"),
    tb._p("n_regionkey", "string", "STRING", "n_name"),
]}


@query("rename_swap", "SELECT n_nationkey, n_regionkey AS n_name, n_name AS n_regionkey FROM nation")
def rename_swap(spark, d):
    return staged(table(spark, d, "nation"), ObjectSpec.from_dict(NATION_SWAP))


@query("cast_widths",
       "SELECT l_orderkey AS order_id, CAST(l_linenumber AS TINYINT) AS line_no, l_partkey AS part_id, "
       "CAST(CAST(l_suppkey AS DECIMAL(20,0)) AS VARCHAR) AS supplier_id, CAST(l_quantity AS INTEGER) AS quantity, "
       "CAST(CAST(l_extendedprice AS FLOAT) AS DOUBLE) AS price FROM lineitem")
def cast_widths(spark, d):
    o = obj(tb.LINEITEM, ["order_id", "line_no", "part_id", "supplier_id", "quantity", "price"])
    out = staged(table(spark, d, "lineitem"), o)
    return out.withColumn("supplier_id", F.col("supplier_id").cast("string")) \
              .withColumn("price", F.col("price").cast("double"))


PART_DIMS = {"name": "part_dims", "properties": [
    tb._p("part_id", "integer", "BIGINT", "p_partkey"),
    {"name": "dims", "logicalType": "object", "physicalType": "STRUCT<size:INT,name:STRING>",
     "properties": [tb._p("name", "string", "STRING"), tb._p("size", "integer", "STRING"),
                    tb._p("color", "string", "STRING")]},
]}


@query("cast_struct_by_name",
       "SELECT p_partkey AS part_id, p_name AS dims_name, CAST(p_size AS BIGINT) AS dims_size, "
       "CAST(NULL AS VARCHAR) AS dims_color FROM part")
def cast_struct_by_name(spark, d):
    src = table(spark, d, "part").select(
        "p_partkey", F.struct(F.col("p_size").alias("size"), F.col("p_name").alias("name")).alias("dims"))
    out = staged(src, ObjectSpec.from_dict(PART_DIMS))
    return out.select("part_id", F.col("dims.name").alias("dims_name"), F.col("dims.size").alias("dims_size"),
                      F.col("dims.color").alias("dims_color"))


PART_ATTRS = {"name": "part_attrs", "properties": [
    tb._p("part_id", "integer", "BIGINT", "p_partkey"),
    {"name": "attrs", "logicalType": "object", "physicalType": "MAP<STRING,STRING>",
     "properties": [tb._p("brand", "string", "STRING"), tb._p("type", "string", "STRING"),
                    tb._p("size", "integer", "STRING"), tb._p("color", "string", "STRING")]},
]}


@query("cast_map_to_struct",
       "SELECT p_partkey AS part_id, p_brand AS attrs_brand, p_type AS attrs_type, "
       "CAST(p_size AS BIGINT) AS attrs_size, CAST(NULL AS VARCHAR) AS attrs_color FROM part")
def cast_map_to_struct(spark, d):
    src = table(spark, d, "part").select(
        "p_partkey",
        F.map_from_arrays(F.array(F.lit("brand"), F.lit("type"), F.lit("size")),
                          F.array("p_brand", "p_type", F.col("p_size").cast("string"))).alias("attrs"))
    out = staged(src, ObjectSpec.from_dict(PART_ATTRS))
    return out.select("part_id", *[F.col(f"attrs.{f}").alias(f"attrs_{f}") for f in ("brand", "type", "size", "color")])


@query("cast_array_items",
       "SELECT vec_id, CAST(len(embedding) AS BIGINT) AS n_items, CAST(embedding[1] AS DOUBLE) AS first_item, "
       "round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 6) AS item_sum FROM embeddings")
def cast_array_items(spark, d):
    out = staged(table(spark, d, "embeddings"), obj(tb.EMBEDDINGS))
    return out.select("vec_id", F.size("embedding").cast("long").alias("n_items"),
                      F.element_at("embedding", 1).alias("first_item"),
                      F.round(F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x), 6).alias("item_sum"))


@query("strict_projection",
       "SELECT event_id, event_type, value AS amount, 'events' AS _source_file FROM events")
def strict_projection(spark, d):
    src = table(spark, d, "events").withColumn("_source_file", F.lit("events")).withColumn("junk", F.lit(1))
    return rename_cast(src, obj(tb.EVENTS, ["event_id", "event_type", "amount", "_source_file"]), EXCLUDE)


# ---------------------------------------------------------------- C1-C9 --------------------------------------------


@query("convert_to_date", "SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_day FROM orders")
def convert_to_date(spark, d):
    src = table(spark, d, "orders").withColumn("order_day_text", F.date_format("o_orderdate", "MM/dd/yyyy"))
    return staged(src, obj(tb.ORDERS, ["order_id", "order_day"]))


CREATED = {"name": "events_created", "properties": [
    tb._p("event_id", "integer", "BIGINT"),
    tb._p("created_at", "timestamp", "STRING", "created_text", options={"format": "yyyy-MM-dd'T'HH:mm:ss"}),
    tb._p("event_time", "time", "STRING", "time_text", options={"format": "HH:mm:ss"}),
]}


@query("convert_to_timestamp",
       "SELECT event_id, date_trunc('second', ts) AS created_at FROM events")
def convert_to_timestamp(spark, d):
    src = table(spark, d, "events").withColumn("created_text", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    out = staged(src, obj(CREATED, ["event_id", "created_at"]))
    return out.select("event_id", F.col("created_at").cast("timestamp_ntz").alias("created_at"))


def _updated_text(df):
    return df.withColumn("updated_text", F.date_format(
        F.expr("timestampadd(HOUR, 8 + o_orderkey % 12, o_orderdate)"), "yyyy-MM-dd HH:mm:ss"))


UPDATED_SQL = "o_orderdate + to_hours(CAST(8 + o_orderkey % 12 AS INTEGER))"


@query("convert_to_utc",
       f"SELECT o_orderkey AS order_id, timezone('UTC', timezone('America/New_York', {UPDATED_SQL})) AS updated_at "
       "FROM orders")
def convert_to_utc(spark, d):
    out = staged(_updated_text(table(spark, d, "orders")), obj(tb.ORDERS, ["order_id", "updated_at"]))
    return out.select("order_id", utc_wall(F.col("updated_at")).alias("updated_at"))


@query("convert_time",
       "SELECT event_id, CAST('1970-01-01' AS DATE) + CAST(strftime(ts, '%H:%M:%S') AS TIME) AS event_time "
       "FROM events")
def convert_time(spark, d):
    src = table(spark, d, "events").withColumn("time_text", F.date_format("ts", "HH:mm:ss"))
    out = staged(src, obj(CREATED, ["event_id", "event_time"]))
    return out.select("event_id", F.col("event_time").cast("timestamp_ntz").alias("event_time"))


@query("convert_json_struct",
       "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS props_k, "
       "json_extract_string(props, '$.j') AS props_j FROM events")
def convert_json_struct(spark, d):
    out = staged(table(spark, d, "events"), obj(tb.EVENTS, ["event_id", "props"]))
    return out.select("event_id", F.col("props.k").alias("props_k"), F.col("props.j").alias("props_j"))


def _words_json(df):
    return df.withColumn("words_json", F.to_json(F.split("p_name", " ")))


@query("convert_json_array",
       "SELECT p_partkey AS part_id, CAST(len(string_split(p_name, ' ')) AS BIGINT) AS n_words, "
       "string_split(p_name, ' ')[1] AS first_word, string_split(p_name, ' ')[-1] AS last_word FROM part")
def convert_json_array(spark, d):
    out = staged(_words_json(table(spark, d, "part")), obj(tb.PART, ["part_id", "words"]))
    return out.select("part_id", F.size("words").cast("long").alias("n_words"),
                      F.element_at("words", 1).alias("first_word"), F.element_at("words", -1).alias("last_word"))


EVENT_PAYLOAD = {"name": "events_payload", "properties": [
    tb._p("event_id", "integer", "BIGINT"),
    tb._p("payload", "object", "STRING", "props"),
]}


@query("convert_variant",
       "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS payload_k FROM events")
def convert_variant(spark, d):
    out = staged(table(spark, d, "events"), ObjectSpec.from_dict(EVENT_PAYLOAD))
    return out.select("event_id", F.variant_get("payload", "$.k", "bigint").alias("payload_k"))


def _payload_b64(df):
    return df.withColumn("payload_b64", F.base64(F.encode("p_name", "UTF-8")))


@query("convert_base64",
       "SELECT p_partkey AS part_id, hex(p_name) AS payload_hex, CAST(octet_length(encode(p_name)) AS BIGINT) "
       "AS payload_bytes FROM part")
def convert_base64(spark, d):
    out = staged(_payload_b64(table(spark, d, "part")), obj(tb.PART, ["part_id", "payload"]))
    return out.select("part_id", F.hex("payload").alias("payload_hex"),
                      F.octet_length("payload").cast("long").alias("payload_bytes"))


LENIENT = {"name": "orders_lenient", "properties": [
    tb._p("order_id", "integer", "BIGINT", "o_orderkey"),
    tb._p("order_day", "date", "STRING", "day_text", options={"format": "MM/dd/yyyy"}),
    tb._p("created", "timestamp", "STRING", "ts_text", options={"format": "yyyy-MM-dd HH:mm:ss"}),
]}


@query("convert_lenient",
       "SELECT o_orderkey AS order_id, "
       "CAST(try_strptime(CASE WHEN o_orderkey % 7 = 0 THEN 'not a date' ELSE strftime(o_orderdate, '%m/%d/%Y') END,"
       " '%m/%d/%Y') AS DATE) AS order_day, "
       "try_strptime(CASE WHEN o_orderkey % 5 = 0 THEN '2024-13-45 25:00:00' "
       "ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END, '%Y-%m-%d %H:%M:%S') AS created FROM orders")
def convert_lenient(spark, d):
    src = table(spark, d, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 7 == 0, F.lit("not a date"))
        .otherwise(F.date_format("o_orderdate", "MM/dd/yyyy")).alias("day_text"),
        F.when(F.col("o_orderkey") % 5 == 0, F.lit("2024-13-45 25:00:00"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("ts_text"))
    out = staged(src, ObjectSpec.from_dict(LENIENT), mode="lenient")
    return out.select("order_id", "order_day", F.col("created").cast("timestamp_ntz").alias("created"))


# ---------------------------------------------------------------- E1-E21 -------------------------------------------

ORDERS_NULLS = {"name": "orders_nulls", "properties": [
    tb._p("order_id", "integer", "BIGINT", "o_orderkey", required=True),
    tb._p("status", "string", "STRING", "status_text", required=True),
    tb._p("priority", "string", "STRING", "priority_text", required=True, options={"minLength": 5}),
]}


@query("expect_required", summary_sql(
    "(SELECT o_orderkey, nullif(o_orderstatus, 'P') AS s, nullif(o_orderpriority, '5-LOW') AS p FROM orders)",
    [("order_id_not_null", "warn", "o_orderkey IS NOT NULL"),
     ("status_not_null", "warn", "s IS NOT NULL"),
     ("priority_not_null", "warn", "p IS NOT NULL"),
     ("priority_min_length", "warn", "length(p) >= 5")]))
def expect_required(spark, d):
    src = table(spark, d, "orders").select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status_text"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority_text"))
    o = ObjectSpec.from_dict(ORDERS_NULLS)
    return summary_of(staged(src, o), o)


@query("expect_length", summary_sql("documents", [
    ("doc_id_not_null", "warn", "doc_id IS NOT NULL"),
    ("text_min_length", "warn", "length(text) >= 100"),
    ("text_max_length", "warn", "length(text) <= 20000"),
    ("lang_pattern", "warn", "regexp_matches(lang, '^(en|fr|de|es)$')"),
    ("n_chars_min", "warn", "n_chars >= 1")]))
def expect_length(spark, d):
    o = obj(tb.DOCUMENTS)
    return summary_of(staged(table(spark, d, "documents"), o), o)


PART_BRAND = {"name": "part_brand", "properties": [
    tb._p("part_id", "integer", "BIGINT", "p_partkey"),
    tb._p("name", "string", "STRING", "p_name", options={"pattern": "^[a-z]+ [a-z]+$"}),
    tb._p("brand", "string", "STRING", "p_brand", options={"pattern": "#1"}),
]}


@query("expect_pattern", summary_sql("pages", [
    ("page_id_not_null", "warn", "page_id IS NOT NULL"),
    ("url_max_length", "warn", "length(url) <= 60"),
    ("url_pattern", "warn", r"regexp_matches(url, '^https://[a-z.]+\.example\.(com|org)/')"),
    ("html_min_length", "warn", "length(html) >= 500")], "pages") + "\nUNION ALL\n" + summary_sql("part", [
    ("name_pattern", "warn", "regexp_matches(p_name, '^[a-z]+ [a-z]+$')"),
    ("brand_pattern", "warn", "regexp_matches(p_brand, '#1')")], "part_brand"))
def expect_pattern(spark, d):
    pages = obj(tb.PAGES)
    part = ObjectSpec.from_dict(PART_BRAND)
    return summary_of(staged(table(spark, d, "pages"), pages), pages, "pages").unionByName(
        summary_of(staged(table(spark, d, "part"), part), part, "part_brand"))


LINEITEM_CHECKS = [
    ("order_id_not_null", "warn", "l_orderkey IS NOT NULL"),
    ("line_no_not_null", "warn", "l_linenumber IS NOT NULL"),
    ("line_no_min", "warn", "l_linenumber >= 1"),
    ("line_no_max", "warn", "l_linenumber <= 7"),
    ("part_id_min", "warn", "l_partkey >= 0"),
    ("quantity_exclusive_min", "warn", "CAST(l_quantity AS INTEGER) > 0"),
    ("quantity_exclusive_max", "warn", "CAST(l_quantity AS INTEGER) < 50"),
    ("price_min", "warn", "CAST(l_extendedprice AS FLOAT) >= 0"),
    ("discount_min", "warn", "l_discount >= 0"),
    ("discount_max", "warn", "l_discount <= 0.1"),
    ("discount_multiple_of", "warn", "CAST(round(l_discount * 100) AS BIGINT) % 2 = 0"),
    ("tax_min", "warn", "l_tax >= 0"),
    ("tax_exclusive_max", "warn", "l_tax < 0.08"),
    ("return_flag_not_null", "warn", "l_returnflag IS NOT NULL"),
    ("return_flag_pattern", "warn", "regexp_matches(l_returnflag, '^[ANR]$')"),
    ("line_status_min_length", "warn", "length(l_linestatus) >= 1"),
    ("line_status_max_length", "warn", "length(l_linestatus) <= 1"),
    ("line_status_pattern", "warn", "regexp_matches(l_linestatus, 'F')"),
    ("ship_ts_min", "warn", "l_shipdate >= TIMESTAMP '1995-01-01 00:00:00'"),
    ("ship_ts_max", "warn", "l_shipdate <= TIMESTAMP '2001-12-31 00:00:00'"),
]

CUSTOMER_BOUND_CHECKS = [
    ("customer_id_not_null", "fail", "c_custkey IS NOT NULL"),
    ("customer_id_min", "fail", "c_custkey >= 0"),
    ("nation_id_min", "warn", "c_nationkey >= 0"),
    ("nation_id_exclusive_max", "warn", "c_nationkey < 25"),
    ("balance_min", "warn", "CAST(c_acctbal AS DECIMAL(12,2)) >= -999.99"),
    ("balance_max", "warn", "CAST(c_acctbal AS DECIMAL(12,2)) <= 9000"),
]


@query("expect_numeric_bounds",
       summary_sql("customer", CUSTOMER_BOUND_CHECKS, "customer") + "\nUNION ALL\n"
       + summary_sql("lineitem", [c for c in LINEITEM_CHECKS if c[0].split("_")[0] in ("quantity", "price", "tax")],
                     "lineitem"))
def expect_numeric_bounds(spark, d):
    cust = obj(tb.CUSTOMER, ["customer_id", "nation_id", "balance"], balance={"minimum": -999.99, "maximum": 9000})
    line = obj(tb.LINEITEM, ["quantity", "price", "tax"])
    return summary_of(staged(table(spark, d, "customer"), cust), cust, "customer").unionByName(
        summary_of(staged(table(spark, d, "lineitem"), line), line, "lineitem"))


@query("expect_multiple_of",
       summary_sql("part", [("size_min", "warn", "p_size >= 1"), ("size_max", "warn", "p_size <= 50"),
                            ("size_multiple_of", "warn", "p_size % 5 = 0")], "part") + "\nUNION ALL\n"
       + summary_sql("lineitem", [c for c in LINEITEM_CHECKS if c[0].startswith("discount")], "lineitem")
       + "\nUNION ALL\n"
       + summary_sql("customer", [("balance_multiple_of", "warn", "CAST(round(c_acctbal * 100) AS BIGINT) % 1 = 0"),
                                  ("balance_2_multiple_of", "warn", "CAST(round(c_acctbal * 100) AS BIGINT) % 5 = 0")],
                     "customer"))
def expect_multiple_of(spark, d):
    part = obj(tb.PART, ["size"])
    line = obj(tb.LINEITEM, ["discount"])
    bal = dict(tb.CUSTOMER["properties"][3], logicalTypeOptions={"multipleOf": 0.01})
    bal2 = dict(bal, name="balance 2", physicalName="balance 2", logicalTypeOptions={"multipleOf": 0.05})
    cust = ObjectSpec.from_dict({"name": "customer", "properties": [bal, bal2]})
    src = table(spark, d, "customer").withColumn("balance 2", F.col("c_acctbal"))
    return (summary_of(staged(table(spark, d, "part"), part), part, "part")
            .unionByName(summary_of(staged(table(spark, d, "lineitem"), line), line, "lineitem"))
            .unionByName(summary_of(staged(src, cust), cust, "customer")))


@query("expect_temporal_bounds",
       summary_sql("orders", [
           ("order_ts_not_null", "warn", "o_orderdate IS NOT NULL"),
           ("order_ts_min", "warn", "o_orderdate >= TIMESTAMP '1995-01-01 00:00:00'"),
           ("order_ts_exclusive_max", "warn", "o_orderdate < TIMESTAMP '2001-06-01 00:00:00'"),
           ("order_day_min", "warn", "CAST(o_orderdate AS DATE) >= DATE '1996-01-01'"),
           ("order_day_max", "warn", "CAST(o_orderdate AS DATE) <= DATE '2000-12-31'")], "orders")
       + "\nUNION ALL\n" + summary_sql("lineitem", [c for c in LINEITEM_CHECKS if c[0].startswith("ship")],
                                       "lineitem"))
def expect_temporal_bounds(spark, d):
    o = obj(tb.ORDERS, ["order_ts", "order_day"])
    src = table(spark, d, "orders").withColumn("order_day_text", F.date_format("o_orderdate", "MM/dd/yyyy"))
    line = obj(tb.LINEITEM, ["ship_ts"])
    return summary_of(staged(src, o), o, "orders").unionByName(
        summary_of(staged(table(spark, d, "lineitem"), line), line, "lineitem"))


DOC_WORDS = {"name": "doc_words", "properties": [
    {"name": "words", "logicalType": "array", "physicalType": "ARRAY<STRING>",
     "logicalTypeOptions": {"minItems": 50, "maxItems": 2000, "uniqueItems": True},
     "items": tb._p("w", "string", "STRING")},
]}


@query("expect_items",
       summary_sql("(SELECT string_split(text, ' ') AS w FROM documents)", [
           ("words_min_items", "warn", "w IS NULL OR (len(w) >= 50)"),
           ("words_max_items", "warn", "w IS NULL OR (len(w) <= 2000)")], "doc_words")
       + "\nUNION ALL\n" + summary_sql("embeddings", [
           ("vec_id_not_null", "warn", "vec_id IS NOT NULL"),
           ("embedding_min_items", "warn", "embedding IS NULL OR (len(embedding) >= 8)"),
           ("embedding_max_items", "warn", "embedding IS NULL OR (len(embedding) <= 60)")], "embeddings"))
def expect_items(spark, d):
    words = obj(DOC_WORDS, words={"minItems": 50, "maxItems": 2000})
    emb = obj(tb.EMBEDDINGS, ["vec_id", "embedding"], embedding={"minItems": 8, "maxItems": 60})
    src = table(spark, d, "documents").select(F.split("text", " ").alias("words"))
    return summary_of(staged(src, words), words, "doc_words").unionByName(
        summary_of(staged(table(spark, d, "embeddings"), emb), emb, "embeddings"))


@query("expect_unique_items",
       summary_sql("(SELECT string_split(text, ' ') AS w FROM documents)", [
           ("words_unique_items", "warn", "w IS NULL OR (len(w) = len(list_distinct(w)))")], "doc_words")
       + "\nUNION ALL\n" + summary_sql("(SELECT string_split(p_name, ' ') AS w FROM part)", [
           ("words_min_items", "warn", "w IS NULL OR (len(w) >= 2)"),
           ("words_max_items", "warn", "w IS NULL OR (len(w) <= 2)"),
           ("words_unique_items", "warn", "w IS NULL OR (len(w) = len(list_distinct(w)))")], "part"))
def expect_unique_items(spark, d):
    words = obj(DOC_WORDS, words={"uniqueItems": True})
    src = table(spark, d, "documents").select(F.split("text", " ").alias("words"))
    part = obj(tb.PART, ["words"])
    return summary_of(staged(src, words), words, "doc_words").unionByName(
        summary_of(staged(_words_json(table(spark, d, "part")), part), part, "part"))


@query("expect_object_field", summary_sql("events", [
    ("props_k_not_null", "warn", "props IS NULL OR (json_extract(props, '$.k') IS NOT NULL)"),
    ("props_j_not_null", "warn", "props IS NULL OR (json_extract(props, '$.j') IS NOT NULL)")]))
def expect_object_field(spark, d):
    o = obj(tb.EVENTS, ["props"])
    return summary_of(staged(table(spark, d, "events"), o), o)


CUSTOMER_NULLS = {"name": "customer_nulls", "properties": [
    tb._p("balance", "number", "DOUBLE", "bal", options={"minimum": 0, "maximum": 5000}),
    tb._p("name", "string", "STRING", "nm", options={"pattern": "^Customer#0000000[0-9]{2}$"}),
]}


@query("expect_null_passes", summary_sql(
    "(SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_acctbal END AS b, "
    "nullif(c_name, 'Customer#000000001') AS n FROM customer)",
    [("balance_min", "warn", "b >= 0"), ("balance_max", "warn", "b <= 5000"),
     ("name_pattern", "warn", "regexp_matches(n, '^Customer#0000000[0-9]{2}$')")]))
def expect_null_passes(spark, d):
    src = table(spark, d, "customer").select(
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit(None)).otherwise(F.col("c_acctbal")).alias("bal"),
        F.nullif("c_name", F.lit("Customer#000000001")).alias("nm"))
    o = ObjectSpec.from_dict(CUSTOMER_NULLS)
    return summary_of(staged(src, o), o)


@query("expect_annotate",
       "SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_partkey AS part_id, concat_ws(',', "
       + ", ".join(f"CASE WHEN NOT coalesce(({p}), true) THEN '{n}' END" for n, _, p in LINEITEM_CHECKS)
       + ") AS violations FROM lineitem")
def expect_annotate(spark, d):
    o = obj(tb.LINEITEM)
    checked = staged(table(spark, d, "lineitem"), o)
    out = annotate(checked, rules(o, checked.columns))
    return out.select("order_id", F.col("line_no").cast("int").alias("line_no"), "part_id",
                      F.array_join("_violations", ",").alias("violations"))


@query("expect_summary", summary_sql("lineitem", LINEITEM_CHECKS))
def expect_summary(spark, d):
    o = obj(tb.LINEITEM)
    return summary_of(staged(table(spark, d, "lineitem"), o), o)


ORDERS_CRITICAL = {"name": "orders_critical", "properties": [
    tb._p("order_id", "integer", "BIGINT", "o_orderkey", required=True, criticalDataElement=True,
          options={"minimum": 0}),
    tb._p("status", "string", "STRING", "o_orderstatus", criticalDataElement=True, options={"pattern": "^[FOP]$"}),
    tb._p("total", "number", "DOUBLE", "o_totalprice", options={"maximum": 100}),
]}


@query("expect_critical",
       "SELECT o_orderkey AS order_id, o_orderstatus AS status, o_totalprice AS total FROM orders")
def expect_critical(spark, d):
    o = ObjectSpec.from_dict(ORDERS_CRITICAL)
    checked = staged(table(spark, d, "orders"), o)
    return gate(checked, rules(o, checked.columns))


# ---------------------------------------------------------------- W1-W4 --------------------------------------------

CUSTOMER_WRITE = dict(tb.CUSTOMER, properties=tb.CUSTOMER["properties"] + [
    tb._p("_processing_timestamp", "timestamp", "TIMESTAMP_NTZ"),
    tb._p("__START_AT", "timestamp", "TIMESTAMP_NTZ"),
    tb._p("__END_AT", "timestamp", "TIMESTAMP_NTZ"),
])


@query("write_projection",
       "SELECT c_custkey AS customer_id, c_name AS name, c_nationkey AS nation_id, "
       "CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS DOUBLE) AS balance, c_mktsegment AS segment, "
       "'customer' AS _source_file, CAST(NULL AS TIMESTAMP) AS _processing_timestamp, "
       "CAST(NULL AS TIMESTAMP) AS __START_AT, CAST(NULL AS TIMESTAMP) AS __END_AT FROM customer")
def write_projection(spark, d):
    o = ObjectSpec.from_dict(CUSTOMER_WRITE)
    exclude = EXCLUDE | {"_processing_timestamp"}
    src = table(spark, d, "customer").withColumn("_source_file", F.lit("customer"))
    checked = rename_cast(convert(load(src, o, exclude), o, exclude), o, exclude)
    out = write_frame(checked, o, exclude)
    return out.withColumn("balance", F.col("balance").cast("double"))


@query("key_violations",
       "SELECT l_orderkey AS order_id, l_linenumber AS line_no, count(*) AS n_rows, "
       "CASE WHEN l_orderkey IS NULL OR l_linenumber IS NULL THEN 'null_key' ELSE 'duplicate' END AS violation "
       "FROM lineitem GROUP BY l_orderkey, l_linenumber "
       "HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL")
def q_key_violations(spark, d):
    o = obj(tb.LINEITEM, ["order_id", "line_no"])
    out = key_violations(staged(table(spark, d, "lineitem"), o), primary_key(o))
    return out.withColumn("line_no", F.col("line_no").cast("int"))


# ---------------------------------------------------------------- G1-G3 --------------------------------------------

_TRIM_KEY = ("trim(CASE WHEN strpos(tag, ':') > 0 THEN substr(tag, 1, strpos(tag, ':') - 1) ELSE tag END)")
_TRIM_VAL = "CASE WHEN strpos(tag, ':') > 0 THEN trim(substr(tag, strpos(tag, ':') + 1)) ELSE '' END"


def _tag_rows(df, entity, tags):
    """``(entity, pos, tag)`` rows from a list of tag expressions (one row per tag, NULL tags dropped)."""
    return (df.select(entity, F.posexplode(F.array(*tags)).alias("pos", "tag"))
            .filter(F.col("tag").isNotNull()))


@query("tags_parse",
       "WITH t AS (SELECT doc_id, 0 AS pos, 'lang:' || lang AS tag FROM documents UNION ALL "
       "SELECT doc_id, 1, source FROM documents UNION ALL "
       "SELECT doc_id, 2, 'note: ' || source || ':' || lang FROM documents UNION ALL "
       "SELECT doc_id, 3, ' lang : ' || upper(lang) FROM documents), "
       f"p AS (SELECT doc_id, pos, {_TRIM_KEY} AS key, {_TRIM_VAL} AS value FROM t) "
       "SELECT doc_id, key, value FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, key ORDER BY pos DESC) "
       "AS rn FROM p) WHERE rn = 1")
def tags_parse(spark, d):
    docs = table(spark, d, "documents")
    rows = _tag_rows(docs, "doc_id", [
        F.concat(F.lit("lang:"), "lang"), F.col("source"),
        F.concat(F.lit("note: "), "source", F.lit(":"), "lang"), F.concat(F.lit(" lang : "), F.upper("lang"))])
    return parse_tags(rows, "tag", ["doc_id"], "pos")


@query("tags_merge",
       "WITH t AS (SELECT doc_id, 0 AS level, 0 AS pos, 'source:' || source AS tag FROM documents UNION ALL "
       "SELECT doc_id, 0, 1, 'tier:base' FROM documents UNION ALL "
       "SELECT doc_id, 0, 2, 'lang:any' FROM documents UNION ALL "
       "SELECT doc_id, 1, 0, 'lang:' || lang FROM documents UNION ALL "
       "SELECT doc_id, 1, 1, CASE WHEN n_chars > 1000 THEN 'tier:long' ELSE 'short' END FROM documents), "
       f"p AS (SELECT doc_id, level, pos, {_TRIM_KEY} AS key, {_TRIM_VAL} AS value FROM t) "
       "SELECT doc_id, key, value FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, key "
       "ORDER BY level DESC, pos DESC) AS rn FROM p) WHERE rn = 1")
def tags_merge(spark, d):
    docs = table(spark, d, "documents")
    base = _tag_rows(docs, "doc_id", [F.concat(F.lit("source:"), "source"), F.lit("tier:base"), F.lit("lang:any")])
    over = _tag_rows(docs, "doc_id", [F.concat(F.lit("lang:"), "lang"),
                                      F.when(F.col("n_chars") > 1000, F.lit("tier:long")).otherwise(F.lit("short"))])
    both = base.withColumn("level", F.lit(0)).unionByName(over.withColumn("level", F.lit(1)))
    parsed = both.select("doc_id", "level", "pos", tag_key(F.col("tag")).alias("key"),
                         tag_value(F.col("tag")).alias("value"))
    return merge_tags(parsed, ["doc_id"], "level", "pos")


@query("tags_per_column",
       "WITH t AS (SELECT doc_id, 0 AS pos, 'quality:' || quality AS tag FROM labels UNION ALL "
       "SELECT doc_id, 1, CASE WHEN toxic = 1 THEN 'toxic' ELSE 'clean:yes' END FROM labels), "
       f"p AS (SELECT doc_id, pos, {_TRIM_KEY} AS key, {_TRIM_VAL} AS value FROM t), "
       "w AS (SELECT doc_id, key, value FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, key "
       "ORDER BY pos DESC) AS rn FROM p) WHERE rn = 1), "
       "g AS (SELECT doc_id, CAST(count(*) AS BIGINT) AS n_tags, string_agg(key || '=' || value, ',' ORDER BY key) "
       "AS tags_text FROM w GROUP BY doc_id) "
       "SELECT d.doc_id, coalesce(g.n_tags, 0) AS n_tags, coalesce(g.tags_text, '') AS tags_text "
       "FROM documents d LEFT JOIN g ON d.doc_id = g.doc_id")
def tags_per_column(spark, d):
    labels = table(spark, d, "labels")
    rows = _tag_rows(labels, "doc_id", [
        F.concat(F.lit("quality:"), F.col("quality").cast("string")),
        F.when(F.col("toxic") == 1, F.lit("toxic")).otherwise(F.lit("clean:yes"))])
    per_doc = tags_per_entity(table(spark, d, "documents").select("doc_id"), parse_tags(rows, "tag", ["doc_id"], "pos"),
                              ["doc_id"])
    entries = F.map_entries("tags")
    return per_doc.select(
        "doc_id", F.size(entries).cast("long").alias("n_tags"),
        F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
        .alias("tags_text"))


# ---------------------------------------------------------------- P1 -----------------------------------------------

CONTRACT_CUSTOMER_SQL = (
    "SELECT c_custkey AS customer_id, c_name AS name, c_nationkey AS nation_id, "
    "CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS DOUBLE) AS balance, c_mktsegment AS segment, "
    "'customer' AS _source_file FROM customer")


def contract_customer_frame(spark, d):
    src = table(spark, d, "customer").withColumn("_source_file", F.lit("customer"))
    return apply_contract(src, obj(tb.CUSTOMER), EXCLUDE)


@query("contract_customer", CONTRACT_CUSTOMER_SQL)
def contract_customer(spark, d):
    return contract_customer_frame(spark, d).frame.withColumn("balance", F.col("balance").cast("double"))


@query("contract_customer_rules", summary_sql("customer", [
    ("customer_id_not_null", "fail", "c_custkey IS NOT NULL"),
    ("customer_id_min", "fail", "c_custkey >= 0"),
    ("name_not_null", "warn", "c_name IS NOT NULL"),
    ("name_min_length", "warn", "length(c_name) >= 3"),
    ("name_max_length", "warn", "length(c_name) <= 64"),
    ("name_pattern", "warn", "regexp_matches(c_name, '^Customer#[0-9]{9}$')"),
    ("nation_id_min", "warn", "c_nationkey >= 0"),
    ("nation_id_exclusive_max", "warn", "c_nationkey < 25"),
    ("balance_min", "warn", "CAST(c_acctbal AS DECIMAL(12,2)) >= -999.99"),
    ("balance_max", "warn", "CAST(c_acctbal AS DECIMAL(12,2)) <= 9000"),
    ("balance_multiple_of", "warn", "CAST(round(c_acctbal * 100) AS BIGINT) % 1 = 0"),
    ("segment_not_null", "warn", "c_mktsegment IS NOT NULL"),
    ("segment_pattern", "warn", "regexp_matches(c_mktsegment, '^(AUTOMOBILE|BUILDING|FURNITURE|HOUSEHOLD|MACHINERY)$')"),
]))
def contract_customer_rules(spark, d):
    r = contract_customer_frame(spark, d)
    return r.summary().select("expectation", "action", "checked", "failed")


@query("contract_orders",
       "SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status, o_totalprice AS total, "
       "o_orderdate AS order_ts, CAST(o_orderdate AS DATE) AS order_day, "
       f"timezone('UTC', timezone('America/New_York', {UPDATED_SQL})) AS updated_at, o_orderpriority FROM orders")
def contract_orders(spark, d):
    src = _updated_text(table(spark, d, "orders")) \
        .withColumn("order_day_text", F.date_format("o_orderdate", "MM/dd/yyyy"))
    r = apply_contract(src, obj(tb.ORDERS), EXCLUDE)
    return r.frame.withColumn("updated_at", utc_wall(F.col("updated_at")))


EVENTS_SQL = ("SELECT event_id, ts, user_id, event_type, value AS amount, "
              "CAST(json_extract_string(props, '$.k') AS BIGINT) AS props_k, "
              "json_extract_string(props, '$.j') AS props_j, 'events' AS _source_file FROM events")


def events_flat(df):
    return df.select("event_id", "ts", "user_id", "event_type", "amount", F.col("props.k").alias("props_k"),
                     F.col("props.j").alias("props_j"), "_source_file")


@query("contract_events", EVENTS_SQL)
def contract_events(spark, d):
    src = table(spark, d, "events").withColumn("_source_file", F.lit("events"))
    return events_flat(apply_contract(src, obj(tb.EVENTS), EXCLUDE).frame)
