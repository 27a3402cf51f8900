"""Type resolution (§1.2-1.4), type-text classification and conversion choice, one contract at a time."""

import pytest
from pyspark.sql import types as T

from contractspark.functions import ddl
from contractspark.plans.catalog_queries import EXPECTED, TYPE_MATRIX
from contractspark.spec import ColumnSpec, ContractError
from contractspark.types import conversion_kind, final_type, resolve


def _col(name, lt, pt, fmt=None, tz_false=False, tz=None, kids=()):
    opts = {}
    if fmt:
        opts["format"] = fmt
    if tz_false:
        opts["timezone"] = False
    if tz:
        opts["defaultTimezone"] = tz
    props = tuple(ColumnSpec(name=k, logical_type=klt, physical_type=kpt) for k, klt, kpt in kids if k != "[]")
    items = next((ColumnSpec(name="items", logical_type=klt, physical_type=kpt) for k, klt, kpt in kids if k == "[]"),
                 None)
    return ColumnSpec(name=name, logical_type=lt, physical_type=pt, options=opts, properties=props, items=items)


@pytest.mark.parametrize("row", TYPE_MATRIX, ids=[r[0] for r in TYPE_MATRIX])
def test_type_matrix_final_type_and_conversion(spark, row):
    c = _col(*row)
    want_type, want_conv = EXPECTED[row[0]]
    assert final_type(c).text == want_type
    assert conversion_kind(c) == want_conv


@pytest.mark.parametrize("fmt,text,dtype", [
    ("i8", "TINYINT", T.ByteType()), ("i16", "SMALLINT", T.ShortType()), ("i32", "INT", T.IntegerType()),
    ("i64", "BIGINT", T.LongType()), ("u8", "SMALLINT", T.ShortType()), ("u16", "INT", T.IntegerType()),
    ("u32", "BIGINT", T.LongType()), ("u64", "DECIMAL(20,0)", T.DecimalType(20, 0)),
    ("i128", "DECIMAL(38,0)", T.DecimalType(38, 0)), ("u128", "DECIMAL(38,0)", T.DecimalType(38, 0)),
    ("foo", "BIGINT", T.LongType()),
])
def test_integer_widths(spark, fmt, text, dtype):
    r = resolve(_col("x", "integer", "INT", fmt))
    assert (r.text, r.dtype) == (text, dtype)


def test_unknown_format_still_beats_physical(spark):
    # a truthy but unknown format pins the logical default, even over a compatible physical type
    assert resolve(_col("x", "integer", "INT", "foo")).text == "BIGINT"
    assert resolve(_col("x", "number", "DECIMAL(8,2)", "foo")).text == "DOUBLE"


@pytest.mark.parametrize("lt,pt", [(None, "STRING"), ("string", None), (None, None)])
def test_missing_types_raise(spark, lt, pt):
    with pytest.raises(ContractError) as e:
        resolve(_col("x", lt, pt))
    assert e.value.code == "ODCS-TYPE-001"


def test_unmappable(spark):
    with pytest.raises(ContractError):
        resolve(_col("x", "decimal", "NUMBER(10)"))
    with pytest.raises(ContractError):
        resolve(_col("x", "array", "NUMBER(10)"))
    assert resolve(_col("x", "array", "ARRAY<INT>")).text == "ARRAY<INT>"


def test_unstorable_types_carried_as_string(spark):
    for pt in ("INTERVAL", "GEOGRAPHY", "GEOMETRY"):
        r = resolve(_col("x", "string", pt))
        assert r.text == pt and not r.supported and r.dtype == T.StringType()
    assert resolve(_col("x", "string", "CHAR(3)")).dtype == T.StringType()


def test_nested_struct_dtype_built_by_name(spark):
    c = ColumnSpec(name="o", logical_type="object", physical_type="STRING", properties=(
        ColumnSpec(name="street name", logical_type="string", physical_type="STRING"),
        ColumnSpec(name="n", logical_type="integer", physical_type="STRING", options={"format": "i16"})))
    r = resolve(c)
    assert r.text == "STRUCT<street name:STRING,n:SMALLINT>"
    assert r.dtype == T.StructType([T.StructField("street name", T.StringType()), T.StructField("n", T.ShortType())])


# fixed cases: text → family (None = not a valid, complete type)
FAMILIES = [
    ("BIGINT", "integer"), ("tinyint", "integer"), ("Long", "integer"), ("INT(5)", "integer"),
    ("DECIMAL(18,2)", "fractional"), ("decimal (18, 2)", "fractional"), ("REAL", "fractional"), ("DEC", "fractional"),
    ("STRING", "string"), ("CHAR", "string"), ("varchar(20)", "string"), ("BOOL", "boolean"), ("DATE", "date"),
    ("TIMESTAMP_NTZ", "timestamp"), ("BINARY", "binary"), ("INTERVAL", "interval"), ("GEOGRAPHY", "geography"),
    ("GEOMETRY", "geometry"), ("VOID", "other"), ("NULL", "other"), ("VARIANT", "variant"),
    ("ARRAY<INT>", "array"), ("array < string >", "array"), ("MAP<STRING,ARRAY<INT>>", "map"),
    ("STRUCT<a:INT,b:ARRAY<STRING>>", "struct"), ("STRUCT<INT:INT>", "struct"),
    ("STRUCT<a:ARRAY<STRUCT<b:INT>>,c:MAP<STRING,ARRAY<INT>>>", "struct"),
    ("ARRAY", None), ("MAP", None), ("STRUCT", None), ("STRUCT<>", None), ("ARRAY<>", None), ("ARRAY<INT", None),
    ("MAP<STRING>", None), ("STRUCT<a INT>", None), ("STRUCT<1a:INT>", None), ("NUMBER(10)", None), ("", None),
    ("INTERVAL DAY TO SECOND", None), ("INT NOT NULL", None), ("ARRAY<INT>>", None), ("DECIMAL(18,2", None),
]


@pytest.mark.parametrize("text,fam", FAMILIES)
def test_family(text, fam):
    assert ddl.family(text) == fam


@pytest.mark.parametrize("text,fam", FAMILIES)
def test_family_set_based_agrees(spark, text, fam):
    from contractspark.plans.catalog import classify_types

    row = classify_types(spark.createDataFrame([(text,)], "physical_type string")).first()
    assert (row.phys_family if row.phys_valid else None) == fam


@pytest.mark.parametrize("depth", [1, 5, 12, 40])
def test_any_depth_folds(spark, depth):
    from contractspark.functions import ddl
    from contractspark.plans.catalog import classify_types

    good, bad = "ARRAY<" * depth + "STRUCT<a:INT>" + ">" * depth, "ARRAY<" * depth + "NUMBER" + ">" * depth
    rows = classify_types(spark.createDataFrame([(0, good), (1, bad)], "i int, physical_type string")).orderBy("i").collect()
    assert rows[0].phys_valid and rows[0].phys_family == ddl.family(good) == "array"
    assert not rows[1].phys_valid and ddl.family(bad) is None


@pytest.mark.parametrize("lt,pt,opts,kind", [
    ("date", "STRING", {"format": "MM/dd/yyyy"}, "to_date"),
    ("date", "STRING", {}, None),
    ("date", "DATE", {"format": "MM/dd/yyyy"}, None),
    ("timestamp", "STRING", {"format": "yyyy"}, "to_timestamp"),
    ("timestamp", "STRING", {"format": "yyyy", "timezone": False, "defaultTimezone": "UTC"}, "to_utc_timestamp"),
    ("timestamp", "STRING", {"format": "yyyy", "timezone": True, "defaultTimezone": "UTC"}, "to_timestamp"),
    ("timestamp", "STRING", {"format": "yyyy", "timezone": False}, "to_timestamp"),
    ("time", "STRING", {"format": "HH:mm"}, "to_timestamp"),
    ("object", "STRING", {}, "parse_json"),
    ("string", "STRING", {"format": "binary"}, "unbase64"),
    ("string", "STRING", {"format": "email"}, None),
    ("string", "NUMBER(10)", {"format": "byte"}, None),
    ("integer", "STRING", {}, None),
    ("array", "STRING", {}, None),
])
def test_conversion_kinds(lt, pt, opts, kind):
    assert conversion_kind(ColumnSpec(name="c", logical_type=lt, physical_type=pt, options=opts)) == kind
