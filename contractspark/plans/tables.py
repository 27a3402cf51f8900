"""Contracts over the driver's test tables (``region nation customer ... conversations``).

ODCS-shaped mappings, exactly as a YAML contract file would load, so they go through ``ContractSpec.from_dict`` like
any other contract.
"""

from __future__ import annotations

from ..spec import ContractSpec


def _p(name, logical, physical, source=None, **kw):
    d = {"name": name, "logicalType": logical, "physicalType": physical}
    if source:
        d["physicalName"] = source
    opts = kw.pop("options", None)
    if opts:
        d["logicalTypeOptions"] = opts
    d.update(kw)
    return d


CUSTOMER = {
    "name": "customer",
    "description": "Customer master",
    "tags": ["layer:silver", "owner:crm", "pii"],
    "properties": [
        _p("customer_id", "integer", "BIGINT", "c_custkey", required=True, primaryKey=True, primaryKeyPosition=1,
           criticalDataElement=True, description="Customer key", tags=["semantic:identifier"],
           options={"minimum": 0}),
        _p("name", "string", "STRING", "c_name", required=True, tags=["pii:name"],
           options={"minLength": 3, "maxLength": 64, "pattern": "^Customer#[0-9]{9}$"}),
        _p("nation_id", "integer", "INT", "c_nationkey", options={"minimum": 0, "exclusiveMaximum": 25}),
        _p("balance", "number", "DECIMAL(12,2)", "c_acctbal",
           options={"minimum": -999.99, "maximum": 9000, "multipleOf": 0.01}),
        _p("segment", "string", "STRING", "c_mktsegment", required=True,
           options={"pattern": "^(AUTOMOBILE|BUILDING|FURNITURE|HOUSEHOLD|MACHINERY)$"}),
        _p("_source_file", "string", "STRING", description="Source file (operational metadata)"),
    ],
}

ORDERS = {
    "name": "orders",
    "tags": ["layer:silver", "domain:sales"],
    "properties": [
        _p("order_id", "integer", "BIGINT", "o_orderkey", required=True, primaryKey=True, criticalDataElement=True),
        _p("customer_id", "integer", "BIGINT", "o_custkey", required=True, options={"minimum": 0}),
        _p("status", "string", "STRING", "o_orderstatus", options={"pattern": "^[FOP]$", "maxLength": 1}),
        _p("total", "number", "DOUBLE", "o_totalprice", options={"exclusiveMinimum": 0, "maximum": 500000}),
        _p("order_ts", "timestamp", "TIMESTAMP_NTZ", "o_orderdate", required=True,
           options={"minimum": "1995-01-01T00:00:00", "exclusiveMaximum": "2001-06-01T00:00:00"}),
        _p("order_day", "date", "STRING", "order_day_text", options={"format": "MM/dd/yyyy",
                                                                     "minimum": "1996-01-01",
                                                                     "maximum": "2000-12-31"}),
        _p("updated_at", "timestamp", "STRING", "updated_text",
           options={"format": "yyyy-MM-dd HH:mm:ss", "timezone": False, "defaultTimezone": "America/New_York"}),
        _p("o_orderpriority", "string", "STRING", description="operational metadata"),
    ],
}

LINEITEM = {
    "name": "lineitem",
    "properties": [
        _p("order_id", "integer", "BIGINT", "l_orderkey", required=True, primaryKey=True, primaryKeyPosition=1),
        _p("line_no", "integer", "INT", "l_linenumber", required=True, primaryKey=True, primaryKeyPosition=2,
           options={"format": "i8", "minimum": 1, "maximum": 7}),
        _p("part_id", "integer", "BIGINT", "l_partkey", options={"format": "u32", "minimum": 0}),
        _p("supplier_id", "integer", "BIGINT", "l_suppkey", options={"format": "u64"}),
        _p("quantity", "integer", "DOUBLE", "l_quantity",
           options={"format": "i32", "exclusiveMinimum": 0, "exclusiveMaximum": 50}),
        _p("price", "number", "DOUBLE", "l_extendedprice", options={"format": "f32", "minimum": 0}),
        _p("discount", "number", "DECIMAL(12,2)", "l_discount",
           options={"minimum": 0, "maximum": 0.1, "multipleOf": 0.02}),
        _p("tax", "number", "DOUBLE", "l_tax", options={"minimum": 0, "exclusiveMaximum": 0.08}),
        _p("return_flag", "string", "STRING", "l_returnflag", required=True, options={"pattern": "^[ANR]$"}),
        _p("line_status", "string", "STRING", "l_linestatus", options={"minLength": 1, "maxLength": 1,
                                                                       "pattern": "F"}),
        _p("ship_ts", "timestamp", "TIMESTAMP_NTZ", "l_shipdate",
           options={"minimum": "1995-01-01T00:00:00", "maximum": "2001-12-31T00:00:00"}),
    ],
}

EVENTS = {
    "name": "events",
    "tags": ["layer:bronze", "stream"],
    "properties": [
        _p("event_id", "integer", "BIGINT", required=True, primaryKey=True, criticalDataElement=True,
           options={"minimum": 0}),
        _p("ts", "timestamp", "TIMESTAMP_NTZ", required=True),
        _p("user_id", "integer", "BIGINT", options={"minimum": 0}),
        _p("event_type", "string", "STRING", options={"pattern": "^(view|click|purchase|signup)$"}),
        _p("amount", "number", "DOUBLE", "value", options={"minimum": 0, "maximum": 50}),
        {"name": "props", "logicalType": "object", "physicalType": "STRING",
         "logicalTypeOptions": {"required": ["k", "j"]},
         "properties": [_p("k", "integer", "BIGINT"), _p("j", "string", "STRING")]},
        _p("_source_file", "string", "STRING"),
    ],
}

PART = {
    "name": "part",
    "properties": [
        _p("part_id", "integer", "BIGINT", "p_partkey", required=True, primaryKey=True),
        _p("name", "string", "STRING", "p_name", options={"pattern": "^[a-z]+ [a-z]+$"}),
        {"name": "words", "physicalName": "words_json", "logicalType": "array", "physicalType": "STRING",
         "logicalTypeOptions": {"minItems": 2, "maxItems": 2, "uniqueItems": True},
         "items": _p("w", "string", "STRING")},
        _p("payload", "string", "STRING", "payload_b64", options={"format": "byte"}),
        _p("size", "integer", "INT", "p_size", options={"minimum": 1, "maximum": 50, "multipleOf": 5}),
    ],
}

DOCUMENTS = {
    "name": "documents",
    "properties": [
        _p("doc_id", "integer", "BIGINT", required=True, primaryKey=True),
        _p("text", "string", "STRING", options={"minLength": 100, "maxLength": 20000}),
        _p("lang", "string", "STRING", options={"pattern": "^(en|fr|de|es)$"}),
        _p("source", "string", "STRING"),
        _p("n_chars", "integer", "BIGINT", options={"minimum": 1}),
    ],
}

EMBEDDINGS = {
    "name": "embeddings",
    "properties": [
        _p("vec_id", "integer", "BIGINT", required=True),
        {"name": "embedding", "logicalType": "array", "physicalType": "ARRAY<FLOAT>",
         "logicalTypeOptions": {"minItems": 8, "maxItems": 1024},
         "items": _p("x", "number", "FLOAT", options={"format": "f64"})},
        _p("label", "integer", "INT"),
    ],
}

PAGES = {
    "name": "pages",
    "properties": [
        _p("page_id", "integer", "BIGINT", required=True),
        _p("url", "string", "STRING", options={"pattern": r"^https://[a-z.]+\.example\.(com|org)/",
                                                 "maxLength": 60}),
        _p("html", "string", "STRING", options={"minLength": 500}),
    ],
}


def contract(*objects, tags=("layer:bronze", "domain:test")) -> ContractSpec:
    return ContractSpec.from_dict({
        "version": "1.0.0", "kind": "DataContract", "apiVersion": "v3.0.2", "id": "test-tables", "status": "active",
        "tags": list(tags), "schema": list(objects)})


# operational-metadata columns of these contracts (not sourced from the input; added by the loader)
OPERATIONAL = frozenset({"_source_file", "o_orderpriority"})
