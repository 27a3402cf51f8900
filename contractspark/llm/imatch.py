"""Document fingerprints by I-Match over randomised lexicon subsets. DataFrame functions only.

The lexicon holds the terms whose document frequency lies in a band (``least`` to ``most`` as shares of all documents, i.e. an
inverse-document-frequency band): neither the words of every text nor those of a few. A share bounds its size: documents
with d distinct terms each have at most d / least such terms, however many documents there are, so the lexicon can be
broadcast; its count is checked first, and beyond ``broadcast_terms`` the same join runs by shuffle.

A text's lexicon terms, distinct and sorted, are hashed once for each of several random subsets of the lexicon: four
families of 16 subsets that hold a term with probability 1/16, 1/64, 1/256 and 1/1024, so short and long texts both have
subsets with a term or two. The 16 subsets of the first family are the whole lexicon, so every lexicon term is hashed. The fingerprint is the list of these hashes (``-`` where the text has no term of a subset). Likeness is
the share of equal hashes among subsets in which either text has terms. A text without lexicon terms is fingerprinted by
a hash of itself, which is like equal texts only.

Defined cases: null text is empty; a text's terms are runs of letters and digits in lower case; an empty text and texts
without lexicon terms have likeness 1 to equal texts and 0 to others; "next" goes by ascending id, then hash of the text,
null ids first, and from the last document to the first, so a single document is its own next; repeated rows are documents
of their own; an empty table gives no rows. Ids must be numbers. The result has columns of its own only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contractspark.llm.common import stored

#: Subsets of a family, and for each family the number of parts of the lexicon of which its subsets are the first ones.
SUBSETS, FAMILIES = 16, (16, 64, 256, 1024)


def term_hashes(text: Column) -> Column:
    """Hashes of the distinct terms of a text."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, least: float, most: float) -> DataFrame:
    """(h): hashes of the terms in the frequency band; docs has ``text``. Counts are partial before they are shuffled."""
    n = docs.count()
    df = docs.select(F.explode(term_hashes(F.col("text"))).alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("df"))
    return df.where((F.col("df") >= max(2, least * n)) & (F.col("df") <= max(2, most * n))).select("h")


def family_hashes(terms: Column, family: int, parts: int) -> Column:
    """Hashes of the family's subsets. Terms are dealt to parts once; the array of one holds that for all subsets."""
    def dealt(h: Column) -> Column:
        return F.struct(F.pmod(F.xxhash64(h, F.lit(family)), F.lit(parts)).alias("part"), h.alias("h"))

    def hashes(own: Column) -> Column:
        def subset(j: Column) -> Column:
            return F.transform(F.array(F.filter(own, lambda x: x["part"] == j)), lambda t: F.when(F.size(t) > 0, F.hash(t)))[0]

        return F.transform(F.sequence(F.lit(0), F.lit(SUBSETS - 1)), subset)

    return F.transform(F.array(F.filter(F.transform(terms, dealt), lambda x: x["part"] < SUBSETS)), hashes)[0]


def subset_hashes(terms: Column) -> Column:
    """Hash of the sorted terms in each subset, null for none; ``terms`` is sorted and distinct."""
    return F.concat(*(family_hashes(terms, k, parts) for k, parts in enumerate(FAMILIES)))


def fingerprint(hashes: Column, text_hash: Column) -> Column:
    joined = F.array_join(F.transform(hashes, lambda x: F.coalesce(F.lower(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), F.lit("-"))), ".")
    return F.when(F.exists(hashes, lambda x: x.isNotNull()), joined).otherwise(F.concat(F.lit("text "), F.lower(F.hex(text_hash))))


def likeness(a: Column, a_print: Column, b: Column, b_print: Column) -> Column:
    """Share of equal hashes among the subsets that either has."""
    either = F.size(F.filter(F.zip_with(a, b, lambda x, y: x.isNotNull() | y.isNotNull()), lambda x: x))
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False))), lambda x: x))
    return F.when(either > 0, equal / either).otherwise((a_print == b_print).cast("double"))


def in_id_order(docs: DataFrame, buckets: int) -> DataFrame:
    """(b, head, id, th, text): documents in range buckets of ids, each with the following bucket's first as its last row.

    Bucket bounds are approximate quantiles of the ids; with the row that follows in its bucket, any row's successor is found
    without a global sort. Only the bounds (one per bucket) come to the driver; as many first rows are broadcast.
    """
    bounds = docs.agg(F.percentile_approx("id", [(i + 1) / buckets for i in range(buckets - 1)], 10 * buckets)).first()[0] if buckets > 1 else None
    bounds = F.lit(sorted(set(bounds or []))).cast("array<double>")
    b = F.when(F.col("id").isNull(), 0).otherwise(F.size(F.filter(bounds, lambda x: x < F.col("id"))))
    keyed = docs.select(b.alias("b"), "id", F.xxhash64("text").alias("th"), "text")
    first = keyed.groupBy("b").agg(F.min(F.struct("id", "th")).alias("x"))
    around = Window.orderBy("b")  # a row per bucket
    last = F.last("b").over(around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = first.select(F.coalesce(F.lag("b").over(around), last).alias("to"), F.col("x.id").alias("hid"), F.col("x.th").alias("hth"))
    found = keyed.join(F.broadcast(heads), F.col("id").eqNullSafe(F.col("hid")) & (F.col("th") == F.col("hth")))
    heads = found.groupBy("to").agg(F.min("id").alias("id"), F.min("th").alias("th"), F.min("text").alias("text"))
    return (keyed.withColumn("head", F.lit(False))
            .unionByName(heads.withColumnsRenamed({"to": "b"}).withColumn("head", F.lit(True))))


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: float = 0.001, most: float = 0.25,
                 broadcast_terms: int = 1_000_000) -> DataFrame:
    """id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every document.

    The edited text has its last half (rounded down) replaced by as much of the next document's beginning.
    """
    spark = docs.sparkSession
    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    terms = stored(lexicon(src, least, most), "lexicon")
    terms = F.broadcast(terms) if terms.count() <= broadcast_terms else terms

    order = Window.partitionBy("b").orderBy("head", "id", "th")
    n, half = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    follows = in_id_order(src, int(spark.conf.get("spark.sql.shuffle.partitions"))).withColumns(
        {"rn": F.row_number().over(order), "next": F.coalesce(F.lead("text").over(order), F.lit(""))})
    edited = follows.withColumn("edited", F.concat(F.left("text", n - half), F.left("next", half)))
    about = F.struct("id", "head", "th", n.cast("long").alias("n"), F.xxhash64("edited").alias("eth"), F.sha2(F.col("edited").cast("binary"), 256).alias("sha"))
    none = F.lit(None).cast(edited.select(about.alias("x")).schema["x"].dataType)
    term = lambda tag, text: F.transform(term_hashes(F.col(text)), lambda h: F.struct(h.alias("h"), F.lit(tag).alias("tag"), none.alias("x")))
    # a document's own row of facts goes with its terms, so they meet again without a join
    rows = F.concat(F.array(F.struct(F.lit(None).cast("long").alias("h"), F.lit(-1).alias("tag"), about.alias("x"))), term(0, "text"), term(1, "edited"))
    flat = edited.select("b", "rn", F.explode(rows).alias("r")).select("b", "rn", "r.*")
    kept = flat.join(terms.withColumn("known", F.lit(True)), "h", "left").where("known or tag = -1")
    own = lambda tag: F.array_sort(F.collect_set(F.when(F.col("tag") == tag, F.col("h"))))
    grouped = kept.groupBy("b", "rn").agg(F.max("x").alias("x"), own(0).alias("own"), own(1).alias("edits"))
    hashed = grouped.select("b", "rn", "x", subset_hashes(F.col("own")).alias("f"), subset_hashes(F.col("edits")).alias("e"))
    printed = hashed.withColumns({"fp": fingerprint(F.col("f"), F.col("x.th")), "ep": fingerprint(F.col("e"), F.col("x.eth"))})
    by = Window.partitionBy("b").orderBy("rn")
    beside = printed.withColumns({"nf": F.lead("f").over(by), "np": F.lead("fp").over(by)}).where(~F.col("x.head"))
    return beside.select(
        F.col("x.id").alias(id_col), F.col("x.n").alias("n_chars"), F.col("x.sha").alias("edited_sha256"), F.col("fp").alias("fingerprint"),
        F.col("ep").alias("edited_fingerprint"), likeness(F.col("f"), F.col("fp"), F.col("e"), F.col("ep")).alias("near_edited"),
        likeness(F.col("f"), F.col("fp"), F.col("nf"), F.col("np")).alias("near_next"))
