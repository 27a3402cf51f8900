"""Corpus preparation in five stages, each one operator of ``contractspark.llm`` over all that the stage before kept.

``run`` writes every stage as Parquet in the shared folder and reads it again as the next one's ``docs``. All stages but the
last return the columns of ``documents``; the last returns packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractspark.llm import decontaminate, jaccard, line_dedup, packing, toxicity
from contractspark.llm.common import bounded_batches, stored, table
from contractspark.llm.queries import word_bpe_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine doesn't call toxic; it learns from the labels outside the held-out fold."""
    bounded_batches(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, names=("_score", "_toxic"))
    return scored.where("_toxic = 0").select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later occurrences of three-line windows; a text of which nothing is left goes."""
    bounded_batches(spark)
    out = line_dedup.dedup_lines(docs, names=("_lines_had", "_lines_gone")).where("_lines_gone < _lines_had or _lines_had = 0").select(*[F.col(f"`{c}`") for c in docs.columns])
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near copies (five-word shingles, similarity 0.8 or more).

    The row with the smallest id stays (null ids last, then by hash of the text), of repeated rows one. Rows are told apart by id
    and text, so another text under a dropped row's id stays; texts without words are no copies.
    """
    bounded_batches(spark)
    keyed = docs.withColumn("_hash", F.xxhash64("text"))
    found = jaccard.near_duplicates(keyed, n=5, num=80, den=100, keep=["_hash"]).where("n_shingles > 0 and component_id is not null")
    rows = stored(found.groupBy("component_id", "doc_id", "_hash").agg(F.count(F.lit(1)).alias("n")), "near")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "_hash")
    groups = rows.groupBy("component_id").agg(F.min(order).alias("first"), F.sum("n").alias("rows")).where("rows > 1").select("component_id", "first")
    copies = stored(rows.join(groups, "component_id").select(F.col("doc_id").alias("_of"), F.col("_hash").alias("_text"), (order == F.col("first")).alias("_stays"),
                                                             (F.col("n") > 1).alias("_repeated")), "copies")
    told = F.broadcast(copies) if copies.count() <= jaccard.BROADCAST_IDS else copies  # beyond that many by shuffle, with the same rows
    known = keyed.join(told, F.col("doc_id").eqNullSafe(F.col("_of")) & (F.col("_hash") == F.col("_text")), "left")
    out = known.where("_stays is null or _stays and not _repeated")
    if copies.where("_stays and _repeated").limit(1).count():
        out = out.union(known.where("_stays and _repeated").dropDuplicates(["doc_id", "_hash"]))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which fewer than one word in twenty lies in a benchmark phrase."""
    bounded_batches(spark)
    found = decontaminate.find(docs, table(spark, sf_dir, "benchmark"), result="_found")
    return found.where(~decontaminate.is_contaminated("_found")).select(*[F.col(f"`{c}`") for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All kept documents as pieces of sequences of 2048 ids."""
    bounded_batches(spark)
    return packing.pack_documents(docs, word_bpe_path())


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("packing", pack),
]

#: The trained model, the component search and the tokenizer have no SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
