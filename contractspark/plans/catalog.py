"""The contracts of a whole estate as tables, resolved by set-based Spark jobs.

``scan_contracts`` reads every contract file as one row; ``decode_contracts`` turns each file into one row of typed
fields (a small per-row YAML decoder, the only Python on this path); ``column_catalog`` explodes that into one row
per property (nested ones too). Everything after that (type classification, widths, precedence, nested type
assembly, conversions, error rows, stage schemas, rule lists, collisions) is plain Spark SQL over the catalog, so
an estate of a million columns resolves on the executors like any other table.

Catalog columns (``CATALOG_COLUMNS``): contract, object, path, parent_path, ordinal, depth, is_items, name,
physical_name, logical_type, physical_type, fmt (the ``format`` option when it is a string), fmt_truthy, tz_false,
default_tz, options (JSON text of ``logicalTypeOptions``), required, primary_key, pk_position, critical,
description, has_description, tags, has_properties, has_items.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import types as ty
from ..functions import ddl
from ..functions.names import OUTPUT_NAME_CHARS, number_text, quote_col, rule_word_col, string_text_col
from ..operators.commit import recover, replace_all
from ..functions.ruletable import FIELD_TEMPLATE, OPTION_RULES, REQUIRED_SUFFIX, REQUIRED_TEMPLATE
from ..spec import REQUIRED_CONTRACT_FIELDS, SCD2_COLUMNS, ContractError

CATALOG_DDL = (
    "contract string, object string, path string, parent_path string, ordinal int, depth int, is_items boolean, "
    "name string, physical_name string, logical_type string, physical_type string, fmt string, fmt_truthy boolean, "
    "tz_false boolean, default_tz string, options string, required boolean, primary_key boolean, pk_position int, "
    "critical boolean, description string, has_description boolean, tags array<string>, has_properties boolean, "
    "has_items boolean")
CATALOG_COLUMNS = [c.strip().split(" ")[0] for c in CATALOG_DDL.split(",")]

DECODED_DDL = ("n_docs int, is_mapping boolean, missing array<string>, error string, id string, version string, "
               "tags array<string>, objects array<struct<object:string,ordinal:int,description:string,"
               "has_description:boolean,tags:array<string>>>, columns string")


# ---- L4: contract files as rows ----------------------------------------------------------------------------


#: A contract file of more bytes than this is a fault of that file.
MOST_BYTES = 64 << 20


def scan_contracts(spark: SparkSession, directory: str) -> DataFrame:
    """``(path, prefix, text, fault, digest)``: every ``*.yaml`` / ``*.yml`` under ``directory`` (recursive).

    ``prefix`` is the path relative to ``directory`` without the last extension (``marketing/campaign``). A file that can't be
    read or isn't UTF-8 has no text but a ``fault``; ``digest`` is the hash of its bytes. Files whose names start with ``_``
    or ``.`` count too; Spark's readers leave them out. Hidden folders are given to the reader as roots of their own; files with
    hidden names, which it refuses even by name, are opened in tasks. The driver sees names only. A directory that does not
    exist gives an empty frame.
    """
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(directory)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return spark.createDataFrame([], "path string, prefix string, text string, fault string, digest string")
    base = fs.makeQualified(root).toUri().getPath().rstrip("/")  # decoded, absolute, without the scheme
    folders, names = _hidden(fs, root)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{yaml,yml}")
    files = reader.load([directory, *folders]).select("path", F.when(F.col("length") <= MOST_BYTES, F.col("content")).alias("content"),
                                                      F.when(F.col("length") > MOST_BYTES, F.lit("the file is too large")).alias("fault"))
    if names:
        paths = spark.createDataFrame([(n,) for n in names], "path string").repartition(min(len(names), 1000))
        files = files.unionByName(paths.mapInArrow(_opened, "path string, content binary, fault string"))
    plain = F.regexp_replace("path", r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?", "")
    rel = F.substring(plain, len(base) + 2, 1 << 30)
    text = F.try_validate_utf8(F.col("content").cast("string"))
    fault = F.coalesce("fault", F.when(text.isNull(), F.lit("the file is not UTF-8")))
    return files.select("path", F.regexp_replace(rel, r"\.[^./]*$", "").alias("prefix"), text.alias("text"), fault.alias("fault"),
                        F.sha2(F.coalesce("content", F.lit(b"")), 256).alias("digest"))


def _hidden(fs, root) -> tuple[list[str], list[str]]:
    """Folders with hidden names that hold contract files, and contract files with hidden names."""
    folders, names, walk, base = set(), [], fs.listFiles(root, True), len(fs.makeQualified(root).toString().rstrip("/"))
    while walk.hasNext():
        path = walk.next().getPath().toString()
        if not path.endswith((".yaml", ".yml")) or not re.search(r"/[_.]", path[base:]):
            continue
        if re.search(r"/[_.][^/]*$", path):
            names.append(path)
        else:
            last = re.match(r"^(.*/[_.][^/]*)/", path)  # the innermost hidden folder: below it nothing is hidden
            folders.add(last[1])
    return [re.sub(r"([{}\[\]*?\\])", r"\\\1", f) for f in sorted(folders)], names


def _opened(batches):
    """(path, content, fault) of files, opened where the task runs."""
    from pyarrow import RecordBatch, array, binary, string
    from pyarrow import fs as files

    for batch in batches:
        out = []
        for path in batch.column(0).to_pylist():
            try:
                scheme, rest = re.match(r"^(?:([a-zA-Z][a-zA-Z0-9+.-]*):)?(.*)$", path).groups()
                if scheme in (None, "file"):
                    where, name = files.LocalFileSystem(), re.sub(r"^//[^/]*", "", rest)
                else:
                    authority = re.match(r"^(//[^/]*)?(/.*)$", rest)
                    where, top = files.FileSystem.from_uri(f"{scheme}:{authority[1] or '//'}/")
                    name = top.rstrip("/") + authority[2]
                with where.open_input_stream(name, compression=None) as f:
                    content = f.read(MOST_BYTES + 1)
                out.append((path, content, None) if len(content) <= MOST_BYTES else (path, None, "the file is too large"))
            except Exception as e:  # noqa: BLE001  a file that can't be read is that file's fault
                out.append((path, None, f"the file can't be read: {e}"))
        yield RecordBatch.from_arrays([array([r[0] for r in out], string()), array([r[1] for r in out], binary()), array([r[2] for r in out], string())], ["path", "content", "fault"])


# ---- L5: decode each file (per-row helper) and explode to one row per property ----------------------------------


def _path_step(name: str) -> str:
    """A name as one step of a path: marks that paths use are escaped, so different fields never share a path."""
    return re.sub(r"([.\[\\])", r"\\\1", name)


def _mapping(value, what: str) -> dict:
    if value is None:
        return {}
    if not isinstance(value, dict):
        raise ContractError("ODCS-CFG-062", f"{what} must be a mapping, got {type(value).__name__}")
    return value


def _listing(value, what: str) -> list:
    if value is None:
        return []
    if not isinstance(value, list):
        raise ContractError("ODCS-CFG-062", f"{what} must be a list, got {type(value).__name__}")
    return value


def _text(value) -> str | None:
    return None if value is None else str(value)


def _flat(obj_name: str, props, parent: str | None, depth: int):
    """Rows for the properties of an object or field, nested ones after their parent."""
    for i, p in enumerate(_listing(props, f"properties of {parent or obj_name!r}")):
        yield from _flat_one(obj_name, _mapping(p, f"a property of {parent or obj_name!r}"), parent, i, depth, False)


def _flat_one(obj_name: str, p: dict, parent: str | None, ordinal: int, depth: int, is_items: bool):
    name = "items" if is_items else str(p.get("name", ""))
    path = (parent or "") + ("[]" if is_items else ("." if parent is not None else "") + _path_step(name))
    opts = _mapping(p.get("logicalTypeOptions"), f"logicalTypeOptions of {path!r}")
    position = p.get("primaryKeyPosition") or 0
    if not isinstance(position, (int, float)):
        raise ContractError("ODCS-CFG-062", f"primaryKeyPosition of {path!r} must be a number, got {position!r}")
    fmt = opts.get("format")
    # numbers go as the text that rules show, so the estate's rule texts are those of one spec
    shown = {k: number_text(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v for k, v in opts.items()}
    yield {
        "object": obj_name, "path": path, "parent_path": parent, "ordinal": ordinal, "depth": depth,
        "is_items": is_items, "name": None if is_items else name,
        "physical_name": _text(p.get("physicalName")), "logical_type": _text(p.get("logicalType")),
        "physical_type": _text(p.get("physicalType")),
        "fmt": fmt if isinstance(fmt, str) else None, "fmt_truthy": bool(fmt), "tz_false": opts.get("timezone") is False,
        "default_tz": _text(opts.get("defaultTimezone") or None),
        "options": json.dumps(shown, default=str), "required": bool(p.get("required", False)),
        "primary_key": p.get("primaryKey") is True, "pk_position": int(position),
        "critical": bool(p.get("criticalDataElement")), "description": _text(p.get("description")),
        "has_description": "description" in p, "tags": [str(t) for t in _listing(p.get("tags"), f"tags of {path!r}")],
        "has_properties": bool(p.get("properties")), "has_items": bool(p.get("items")),
    }
    yield from _flat(obj_name, p.get("properties"), path, depth + 1)
    if p.get("items"):
        yield from _flat_one(obj_name, _mapping(p["items"], f"items of {path!r}"), path, 0, depth + 1, True)


def decode_text(text: str | None, fault: str | None = None) -> str:
    """One contract file → JSON of its top-level fields, its objects and its flattened properties.

    ``fault`` says why there is no text. Whatever is wrong with a file goes into its own ``error``, so one bad contract never ends the job of an estate.
    """
    import yaml

    res = {"n_docs": 0, "is_mapping": False, "missing": [], "error": None, "id": None, "version": None, "tags": [],
           "objects": [], "columns": "[]"}
    if fault is not None:
        return json.dumps(res | {"error": f"[ODCS-IO-001] {fault}"})
    try:
        # the loader on the C library, where it is installed, reads the same several times as fast
        docs = [d for d in yaml.load_all(text, Loader=getattr(yaml, "CSafeLoader", yaml.SafeLoader)) if d is not None]
        res["n_docs"] = len(docs)
        if len(docs) == 1 and isinstance(docs[0], dict):
            doc = docs[0]
            res |= {"is_mapping": True, "missing": [k for k in REQUIRED_CONTRACT_FIELDS if k not in doc],
                    "id": _text(doc.get("id")), "version": _text(doc.get("version"))}
            tags = [str(t) for t in _listing(doc.get("tags"), "tags")]
            objects, cols = [], []
            for i, o in enumerate(_listing(doc.get("schema"), "schema")):
                o = _mapping(o, "an object of schema")
                name = str(o.get("name", ""))
                objects.append({"object": name, "ordinal": i, "description": _text(o.get("description")), "has_description": "description" in o,
                                "tags": [str(t) for t in _listing(o.get("tags"), f"tags of {name!r}")]})
                cols += _flat(name, o.get("properties"), None, 0)
            res |= {"tags": tags, "objects": objects, "columns": json.dumps(cols, default=str)}
    except yaml.YAMLError as e:
        res["error"] = f"yaml: {str(e).splitlines()[0]}"
    except ContractError as e:
        res["error"] = f"{e}"
    except Exception as e:  # noqa: BLE001  a file's fault of any other kind is that file's row
        res["error"] = f"{type(e).__name__}: {e}"
    return json.dumps(res, default=str)


@F.pandas_udf(T.StringType())
def _decode(texts: pd.Series, faults: pd.Series) -> pd.Series:
    return pd.Series([decode_text(t, f) for t, f in zip(texts, faults)], dtype=object)


def decode_contracts(contracts: DataFrame) -> DataFrame:
    """``(path, prefix, text)``, perhaps with ``fault`` and ``digest`` → one row per file with the decoded fields (K3 inputs,
    objects, properties JSON).

    The decoder is an Arrow-batched pandas UDF over one row per file. Files are dealt over all cores first: a table of many
    contracts may lie in one split.
    """
    spark, more = contracts.sparkSession, [c for c in ("digest",) if c in contracts.columns]
    fault = F.col("fault") if "fault" in contracts.columns else F.lit(None).cast("string")
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = contracts.select("path", "prefix", "text", fault.alias("fault"), *more).repartition(parts)
    return dealt.select("path", "prefix", *more, F.from_json(_decode("text", "fault"), DECODED_DDL).alias("d")).select("path", "prefix", *more, "d.*")


def refresh_decoded(spark: SparkSession, directory: str, store: str) -> dict[str, int]:
    """Bring the decoded contracts in the folder ``store`` up to date with the files; ``{decoded, kept, removed}``.

    Files are read and hashed; only those whose path or bytes are new are decoded, the others' rows are taken from the store. Rows
    of files that are gone go. The new version takes the old one's place when complete (``operators.commit``).
    """
    found = scan_contracts(spark, directory)
    recover(spark, store.rstrip("/").rpartition("/")[0] or ".")
    try:
        old = spark.read.parquet(store)
    except AnalysisException:  # nothing stored yet
        old = decode_contracts(found.limit(0))
    same, seen = ["path", "digest"], Observation("decoded")
    kept = old.join(found.select(*same), same, "left_semi").select(*old.columns)
    fresh = found.join(old.select(*same), same, "left_anti").observe(seen, F.count(F.lit(1)).alias("n"))
    before = old.count()
    replace_all(spark, [(store, kept.unionByName(decode_contracts(fresh).select(*old.columns)).write.save)])
    after = spark.read.parquet(store).count()
    return {"decoded": seen.get["n"], "kept": after - seen.get["n"], "removed": before - (after - seen.get["n"])}


def column_catalog(decoded: DataFrame) -> DataFrame:
    """One row per property of every object (``CATALOG_COLUMNS``), contract = the file's prefix."""
    cols = F.from_json("columns", f"array<struct<{_struct_fields(CATALOG_DDL, skip={'contract'})}>>")
    return decoded.select(F.col("prefix").alias("contract"), F.explode(cols).alias("c")).select("contract", "c.*")


def object_catalog(decoded: DataFrame) -> DataFrame:
    """One row per schema object occurrence: ``(contract, object, ordinal, description, has_description, tags,
    contract_tags)``."""
    return decoded.select(F.col("prefix").alias("contract"), F.col("tags").alias("contract_tags"),
                          F.explode("objects").alias("o")).select("contract", "o.*", "contract_tags")


def _struct_fields(ddl_text: str, skip=()) -> str:
    parts = [c.strip() for c in ddl_text.split(",")]
    return ",".join(p.replace(" ", ":", 1) for p in parts if p.split(" ")[0] not in skip)


# ---- R1: classify physical type text ------------------------------------------------------------------------


def classify_types(df: DataFrame, column: str = "physical_type", prefix: str = "phys") -> DataFrame:
    """Add ``{prefix}_valid`` and ``{prefix}_family`` for a column of Spark type texts of any nesting depth.

    No UDF: normalise, replace leaf types by ``@``, fold ``ARRAY<@>``/``MAP<@,@>``/``STRUCT<n:@,..>`` once for each ``<``
    of the text.
    """
    norm = ddl.normalize_col(F.col(column))
    valid = F.col(column).isNotNull() & (ddl.fold_col(norm) == "@")
    return df.select("*", valid.alias(f"{prefix}_valid"),
                     F.when(valid, ddl.head_family_col(norm, ddl.families_map_col())).alias(f"{prefix}_family"))


# ---- R2, R3, R5: widths, precedence, conversion kind --------------------------------------------------------


def _lit_map(d: dict) -> Column:
    return F.create_map(*[x for k, v in d.items() for x in (F.lit(k), F.lit(v))])


def _compat_map() -> Column:
    return F.create_map(*[x for k, v in ty.COMPATIBLE_FAMILIES.items()
                          for x in (F.lit(k), F.array(*[F.lit(f) for f in sorted(v)]))])


def _scalar_resolution(df: DataFrame) -> DataFrame:
    """``flat_text``: the type of a row without a shape, by the candidates of ``types.scalar_candidates`` in their order."""
    lt, pt = F.col("logical_type"), F.col("physical_type")
    absent = [(F.coalesce(c, F.lit("")) == "", n) for c, n in ((pt, "physicalType"), (lt, "logicalType"))]
    missing = absent[0][0] | absent[1][0]
    sized = lt.isin(*ty.WIDTHS)
    width = F.coalesce(*(F.when(lt == name, F.coalesce(F.element_at(_lit_map(widths), F.col("fmt")), F.lit(usual)))
                         for name, (widths, usual) in ty.WIDTHS.items()))
    compatible = F.col("phys_valid") & F.array_contains(F.element_at(_compat_map(), lt), F.col("phys_family"))
    flat = F.coalesce(F.when(sized & F.col("fmt_truthy"), width), F.when(compatible, pt), F.when(sized, width),
                      F.element_at(_lit_map(ty.LOGICAL_DEFAULTS), lt))
    shape = ((lt == "object") & F.col("has_properties")) | ((lt == "array") & F.col("has_items"))
    named = F.concat_ws(" and ", *(F.when(c, F.lit(n)) for c, n in absent))
    return df.withColumns({
        "missing_types": missing, "shape": F.coalesce(shape & ~missing, F.lit(False)), "flat_text": F.when(~missing, flat),
        "missing_reason": F.when(missing, F.concat(F.lit("missing "), named))})


#: What the assembly passes from a nested row to its parent, and what it finds for every row.
_OPEN = "array<struct<parent:string,ordinal:int,name:string,is_items:boolean,text:string>>"
_DONE = "array<struct<text:string,n:int,bad:boolean>>"


def _assembled(nodes: Column) -> Column:
    """For each row of one column's tree (``nodes``, deepest first): its type text, its number of children, if one is bad.

    One pass: a row takes the texts of its children, which have all gone before it, and leaves its own for its parent.
    """
    def step(state: Column, x: Column) -> Column:
        may = F.coalesce(x["has_properties"], F.lit(False)) | F.coalesce(x["has_items"], F.lit(False)) | x["shape"]
        kids = F.when(may, F.filter(state["open"], lambda k: k["parent"] == x["path"])).otherwise(F.array().cast(_OPEN))  # a leaf looks for none
        fields = F.transform(F.array_sort(F.transform(F.filter(kids, lambda k: ~k["is_items"]), lambda k: F.struct(k["ordinal"], k["name"], k["text"]))),
                             lambda k: F.concat(k["name"], F.lit(":"), k["text"]))
        item = F.array_max(F.transform(F.filter(kids, lambda k: k["is_items"]), lambda k: k["text"]))
        n, bad = F.size(kids), F.exists(kids, lambda k: k["text"].isNull())
        text = (F.when(~x["shape"] | (n == 0), x["flat_text"])  # a declared shape without any child is none
                .when(bad, F.lit(None))
                .when(x["logical_type"] == "object", F.concat(F.lit("STRUCT<"), F.array_join(fields, ","), F.lit(">")))
                .otherwise(F.concat(F.lit("ARRAY<"), item, F.lit(">"))))
        own = F.array(F.struct(x["parent_path"].alias("parent"), x["ordinal"].alias("ordinal"), x["name"].alias("name"),
                               x["is_items"].alias("is_items"), text.alias("text")))
        return F.struct(F.concat(F.when(may, F.filter(state["open"], lambda k: ~k["parent"].eqNullSafe(x["path"]))).otherwise(state["open"]), own).cast(_OPEN).alias("open"),
                        F.concat(state["done"], F.array(F.struct(text.alias("text"), n.alias("n"), (bad & x["shape"]).alias("bad")))).cast(_DONE).alias("done"))

    start = F.struct(F.array().cast(_OPEN).alias("open"), F.array().cast(_DONE).alias("done"))
    return F.aggregate(nodes, start, step, lambda state: state["done"])


def resolve_types(catalog: DataFrame) -> DataFrame:
    """Every catalog row gets ``type_text`` (resolved type), top-level rows get ``conversion``,
    ``final_type`` (transform / write type) and ``load_type``; ``error`` names what could not be resolved.

    Nested shapes (R4) are assembled per top-level column: its rows, at any depth, meet in one group (which one contract's
    column bounds) and are folded from the deepest up. One scan and one shuffle, whatever the depth.
    """
    flat = _scalar_resolution(classify_types(catalog))
    top = F.regexp_extract("path", r"^((?:\\.|[^.\[\\])*)", 1)
    nodes = flat.select("contract", "object", top.alias("__top"), F.struct((-F.col("depth")).alias("up"), "path", "ordinal", F.struct(*flat.columns).alias("row")).alias("n"))
    trees = nodes.groupBy("contract", "object", "__top").agg(F.collect_list("n").alias("ns"))
    tied = F.transform("ns", lambda n: F.struct(n["up"], n["path"], n["ordinal"], F.xxhash64(F.to_json(n["row"])).alias("tie"), n["row"].alias("row")))
    told = F.size(F.array_distinct(F.col("ns.path"))) == F.size("ns")  # else repeated paths go by ordinal and a hash of the row
    trees = trees.select(F.when(told, F.transform(F.sort_array("ns"), lambda x: x["row"])).otherwise(F.transform(F.sort_array(tied), lambda x: x["row"])).alias("rows"))
    rows = F.col("rows")
    each = trees.select(F.explode(F.arrays_zip(rows.alias("row"), _assembled(rows).alias("made"))).alias("x"))
    lt = F.col("logical_type")
    reason = (F.when(F.col("made.bad") & (F.col("made.n") > 0), F.lit("a nested field cannot be resolved"))
              .when(F.col("made.text").isNull() & (lt == "array"), F.lit("array without items and no usable physical type"))
              .when(F.col("made.text").isNull(), F.concat(F.lit("logical type cannot be mapped: "), lt)))
    df = each.select("x.row.*", F.col("x.made").alias("made")).withColumns({
        "type_text": F.col("made.text"), "error": F.coalesce("missing_reason", reason), "n_children": F.col("made.n")})
    return _conversions(df.drop("made", "missing_reason", "flat_text"))


def _conversions(df: DataFrame) -> DataFrame:
    """Conversion kind (top-level string-family sources only) and the final / load types."""
    lt = F.col("logical_type")
    string_src = F.col("phys_family") == "string"
    kind = (F.when((F.col("depth") != 0) | ~F.coalesce(string_src, F.lit(False)), F.lit(None))
            .when(lt.isin("date", "timestamp", "time") & F.col("fmt").isNull(), F.lit(None))
            .when(lt == "date", F.lit(ty.TO_DATE))
            .when(lt.isin("timestamp", "time") & F.col("tz_false") & F.col("default_tz").isNotNull(),
                  F.lit(ty.TO_UTC_TIMESTAMP))
            .when(lt.isin("timestamp", "time"), F.lit(ty.TO_TIMESTAMP))
            .when((lt == "object") & F.col("has_properties"), F.lit(ty.FROM_JSON_STRUCT))
            .when(lt == "object", F.lit(ty.PARSE_JSON))
            .when((lt == "array") & F.col("has_items"), F.lit(ty.FROM_JSON_ARRAY))
            .when((lt == "string") & F.col("fmt").isin(*sorted(ty.BASE64_FORMATS)), F.lit(ty.UNBASE64)))
    final = (F.when(F.col("type_text").isNull(), F.lit(None))
             .when(F.col("conversion") == ty.TO_DATE, F.lit("DATE"))
             .when(F.col("conversion").isin(ty.TO_TIMESTAMP, ty.TO_UTC_TIMESTAMP), F.lit("TIMESTAMP"))
             .when(F.col("conversion") == ty.PARSE_JSON, F.lit("VARIANT"))
             .when(F.col("conversion") == ty.UNBASE64, F.lit("BINARY"))
             .otherwise(F.col("type_text")))
    return (df.withColumn("conversion", kind)
              .withColumn("final_type", final)
              .withColumn("load_type", F.when(F.col("conversion").isNotNull() & F.col("final_type").isNotNull(),
                                              F.lit("STRING")).otherwise(F.col("final_type"))))


# ---- R6 / K3: error rows ------------------------------------------------------------------------------------


def type_errors(resolved: DataFrame) -> DataFrame:
    """``(contract, object, path, code, reason)`` for every property whose type cannot be resolved."""
    return (resolved.filter(F.col("error").isNotNull())
            .select("contract", "object", "path", F.lit("ODCS-TYPE-001").alias("code"), F.col("error").alias("reason")))


def _err(code: str, reason: Column) -> Column:
    return F.struct(F.lit(code).alias("code"), reason.cast("string").alias("reason"))


def contract_errors(decoded: DataFrame) -> DataFrame:
    """K3: ``(path, code, reason)`` for files that are not exactly one mapping with the required top-level fields."""
    coded = F.regexp_extract("error", r"^\[([A-Z0-9-]+)\]", 1)
    checks = F.array(
        F.when(F.col("error").isNotNull(), F.struct(F.when(coded != "", coded).otherwise(F.lit("ODCS-IO-002")).alias("code"),
                                                    F.regexp_replace("error", r"^\[[A-Z0-9-]+\] ", "").alias("reason"))),
        F.when(F.col("error").isNull() & (F.col("n_docs") != 1),
               _err("ODCS-IO-003", F.concat(F.lit("expected one document, found "), F.col("n_docs").cast("string")))),
        F.when((F.col("n_docs") == 1) & ~F.col("is_mapping"), _err("ODCS-IO-004", F.lit("the document is not a mapping"))),
        F.when(F.size("missing") > 0,
               _err("ODCS-CFG-062", F.concat(F.lit("missing required fields: "), F.array_join("missing", ", ")))),
    )
    return (decoded.select("path", F.explode(F.filter(checks, lambda x: x.isNotNull())).alias("e"))
            .select("path", "e.code", "e.reason"))


# ---- R7: stage schemas -------------------------------------------------------------------------------------


def stage_schemas(resolved: DataFrame, exclude=SCD2_COLUMNS) -> DataFrame:
    """Per top-level column, the load / transform / write name, type and nullability.

    Load and transform leave excluded columns out (their ``load_*``/``transform_*`` are NULL); write keeps all.
    """
    excl = F.col("name").isin(*sorted(exclude)) if exclude else F.lit(False)
    return (resolved.filter(F.col("depth") == 0).select(
        "contract", "object", "ordinal", "name", excl.alias("excluded"),
        F.when(~excl, F.coalesce("physical_name", "name")).alias("load_name"),
        F.when(~excl, F.col("load_type")).alias("load_type"),
        F.when(~excl, ~F.col("required")).alias("load_nullable"),
        F.when(~excl, F.col("name")).alias("transform_name"),
        F.when(~excl, F.col("final_type")).alias("transform_type"),
        F.col("name").alias("write_name"), F.col("final_type").alias("write_type"),
        (~(F.col("required") | F.col("primary_key"))).alias("write_nullable")))


def primary_keys(catalog: DataFrame) -> DataFrame:
    """W3 over the estate: ``(contract, object, primary_key array<string>)`` ordered by position, then ordinal."""
    pk = catalog.filter((F.col("depth") == 0) & F.col("primary_key"))
    return pk.groupBy("contract", "object").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pk_position", "ordinal", "name"))),
                    lambda x: x["name"]).alias("primary_key"))


# ---- R8: rule list -----------------------------------------------------------------------------------------


def _opt(key: str) -> Column:
    """A top-level option as text, null if absent."""
    return F.get_json_object(F.col("options"), f"$.{key}")


def _num(c: Column) -> Column:
    """Truth values as 0/1, whole numbers without a trailing ``.0``."""
    return (F.when(c == "true", F.lit("1")).when(c == "false", F.lit("0"))
            .when(c.rlike(r"^-?[0-9]+\.0+$"), F.regexp_replace(c, r"\.0+$", "")).otherwise(c))


def _filled(template: str, **values: Column) -> Column:
    """A rule text from its template over columns."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*(values[p] if i % 2 else F.lit(p) for i, p in enumerate(parts) if p))


def expectation_catalog(catalog: DataFrame) -> DataFrame:
    """One row per rule of E1-E17 for every top-level column of the estate.

    ``(contract, object, column_name, column_ordinal, rule_ordinal, expectation, expression, action)``; names are
    made unique per object (``_2``, ``_3``... in declaration order) with a window over the base name.
    """
    top = catalog.filter(F.col("depth") == 0)
    q, s, lt = quote_col(F.col("name")), rule_word_col(F.col("name")), F.col("logical_type")

    def rule(i: int, cond: Column, suffix: str, expr: Column) -> Column:
        return F.when(cond, F.struct(F.lit(i).alias("rule_ordinal"), F.concat(s, F.lit(f"_{suffix}")).alias("base"), expr.alias("expression")))

    made = [rule(0, F.col("required"), REQUIRED_SUFFIX, _filled(REQUIRED_TEMPLATE, q=q))]
    for i, r in enumerate(OPTION_RULES, 1):
        v = _opt(r.option)
        holds = (v == "true") if r.literal == "none" else v.isNotNull()
        text = _filled(r.template, q=q, v=string_text_col(v) if r.literal == "string" else _num(v))
        made.append(rule(i, lt.isin(*r.types) & holds, r.suffix, text))
    action = F.when(F.col("critical"), F.lit("fail")).otherwise(F.lit("warn")).alias("action")
    head = ["contract", "object", F.col("name").alias("column_name"), F.col("ordinal").alias("column_ordinal"), action]
    # One rule per required field of an object column
    required = F.when(lt == "object", F.from_json(_opt("required"), "array<string>"))
    fields = F.transform(F.coalesce(required, F.array().cast("array<string>")), lambda f, k: F.struct(
        (F.lit(len(made)) + k).alias("rule_ordinal"), F.concat(s, F.lit("_"), rule_word_col(f), F.lit(f"_{REQUIRED_SUFFIX}")).alias("base"),
        _filled(FIELD_TEMPLATE, q=q, v=quote_col(f)).alias("expression")))
    own = F.filter(F.array(*made), lambda x: x.isNotNull())
    allr = top.select(*head, F.explode(F.concat(own, fields)).alias("r")).select("contract", "object", "column_name", "column_ordinal", "action", "r.*")
    n = _rank_in_group(allr, ["contract", "object", "base"], "column_ordinal", "rule_ordinal")
    return n.select("contract", "object", "column_name", "column_ordinal", "rule_ordinal",
                    F.when(F.col("__n") == 1, F.col("base"))
                    .otherwise(F.concat("base", F.lit("_"), F.col("__n").cast("string"))).alias("expectation"),
                    "expression", "action")


def _rank_in_group(df: DataFrame, group, ordinal: str, sub: str, bucket_size: int = 4096) -> DataFrame:
    """Add ``__n``: 1-based position of each row in its group, ordered by ``(ordinal, sub)``.

    A plain ``row_number`` over the group would put a whole group in one task. Instead rows are cut into ordinal
    buckets: the rows before a bucket are counted with a ``groupBy`` (partial counts, skew-safe) and a running sum over
    that group's buckets (one row per bucket), and the position inside a bucket is a ``row_number`` over at most
    ``bucket_size`` ordinals.
    """
    # dealt by (group, bucket) once: the counts and the ranks below use the same exchange
    with_b = df.withColumn("__bucket", F.floor(F.col(ordinal) / F.lit(bucket_size))).repartition(*group, "__bucket")
    counts = with_b.groupBy(*group, "__bucket").agg(F.count(F.lit(1)).alias("__cnt"))
    before = Window.partitionBy(*group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__cnt").over(before), F.lit(0))).drop("__cnt")
    inner = Window.partitionBy(*group, "__bucket").orderBy(ordinal, sub)
    return (with_b.join(offsets, [*group, "__bucket"])
            .withColumn("__n", F.col("__off") + F.row_number().over(inner))
            .drop("__bucket", "__off"))


# ---- K1 / K2: duplicate and colliding object names ---------------------------------------------------------


def name_collisions(objects: DataFrame, contract_col: str = "contract", object_col: str = "object", across: bool = False) -> DataFrame:
    """K1 + K2: object names that appear twice in a contract (``duplicate``) or that differ but become the same
    output name after mapping ``[^A-Za-z0-9_.-]`` to ``_`` (``collision``). One ``groupBy`` on (contract, slug).

    With ``across`` contract names are mapped too, so two contracts whose outputs would land in one place are reported
    (``contract`` is then the mapped name)."""
    def shown(name: str) -> Column:
        return F.regexp_replace(F.col(name), f"[^{OUTPUT_NAME_CHARS}]", "_")

    contract = F.regexp_replace(F.col(contract_col), f"[^{OUTPUT_NAME_CHARS}/]", "_") if across else F.col(contract_col)
    g = objects.groupBy(contract.alias("contract"), shown(object_col).alias("slug")).agg(
        F.count(F.lit(1)).alias("n_objects"), F.countDistinct(F.struct(F.col(contract_col), F.col(object_col))).alias("n_names"))
    return (g.filter(F.col("n_objects") > 1)
            .withColumn("kind", F.when(F.col("n_names") > 1, F.lit("collision")).otherwise(F.lit("duplicate"))))


# ---- G1/G2 over the estate -----------------------------------------------------------------------------------


def table_tags(objects: DataFrame) -> DataFrame:
    """G2 over the estate: ``(contract, object, key, value)``, object tags over contract tags, later over earlier."""
    from ..operators.tags import merge_tags, tag_key, tag_value

    rows = objects.select("contract", "object", F.lit(0).alias("level"),
                          F.posexplode("contract_tags").alias("pos", "tag")).unionByName(
        objects.select("contract", "object", F.lit(1).alias("level"), F.posexplode("tags").alias("pos", "tag")))
    parsed = rows.select("contract", "object", "level", "pos", tag_key(F.col("tag")).alias("key"),
                         tag_value(F.col("tag")).alias("value"))
    return merge_tags(parsed, ["contract", "object"], "level", "pos")
