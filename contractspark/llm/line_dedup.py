"""Line dedup: overlapping windows of three lines, of which every later occurrence goes. DataFrame functions only.

A text is cut after every newline and, as prose often has a paragraph on one line, after every sentence end followed by a
blank (``sentences``). Lines (without trailing blanks) are hashed once, and each three consecutive hashes to 96 bits. Windows
that occur more than once, anywhere, are found by a partial count; only those are joined back, so a window that a third of all
rows hold costs one row per map task in the count and a skew-split join. The first occurrence, by (id, hash of the text, position),
stays; a later one covers its three lines. Covered positions of a text are merged and the lines between them are joined
again, with their own line ends.

If a later occurrence overlaps its own first one (a line repeated over and over), only the lines past the first one are
covered, so three of a run of equal lines stay. Every window counts, however short its lines are; ``least_chars`` can leave
windows with fewer characters out.

Defined cases: null and empty texts have no lines and stay as they are, as do texts of fewer than three lines; rows with
the same id and text are one document and get the same result; null ids come first in the order; an empty table gives no
rows. All columns of the input are carried; the two result columns (``names``) replace columns of those names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractspark.llm.common import without

#: Marks the cuts; a text that holds it is cut by a (slower) pattern instead.
_CUT = "\u0001"


def lines_of(text: Column, sentences: bool = True) -> Column:
    """Lines with their line ends: joined without anything between them they are the text again."""
    ends = ["\n", *([". ", "! ", "? "] if sentences else [])]
    marked = text
    for e in ends:
        marked = F.replace(marked, F.lit(e), F.lit(e + _CUT))
    pattern = r"(?<=\n)|(?<=[.!?] )" if sentences else r"(?<=\n)"
    cut = F.when(F.contains(text, F.lit(_CUT)), F.split(text, pattern)).otherwise(F.split(marked, _CUT))
    return F.filter(cut, lambda x: x != "")


def windows(docs: DataFrame, least_chars: int) -> DataFrame:
    """(_id, _th, pos, h1, h2) of each window of three lines; docs has _id, _th and _lines."""
    many = docs.where(F.size("_lines") >= 3).withColumn("_bare", F.transform("_lines", lambda x: F.rtrim(F.rtrim(x, F.lit("\n")))))
    hashed = many.withColumn("_h", F.transform("_bare", lambda x: F.xxhash64(x)))

    def three(c: str, names: str) -> dict[str, Column]:
        return {names + str(k): F.slice(c, k + 1, F.size(c)) if k else F.col(c) for k in range(3)}

    cols = three("_h", "h")
    if least_chars:
        hashed = hashed.withColumn("_n", F.transform("_bare", lambda x: F.length(x)))
        cols |= three("_n", "n")
    each = hashed.withColumns(cols).select("_id", "_th", F.posexplode(F.arrays_zip(*cols)).alias("pos", "w")).where("w.h2 is not null")
    if least_chars:
        each = each.where(F.col("w.n0") + F.col("w.n1") + F.col("w.n2") >= least_chars)
    lines = [F.col(f"w.h{k}") for k in range(3)]
    return each.select("_id", "_th", "pos", F.xxhash64(*lines).alias("h1"), F.hash(*lines).alias("h2"))


def covered_lines(docs: DataFrame, least_chars: int) -> DataFrame:
    """(_id, _th, _covered): the sorted positions that later occurrences cover, for texts that have some."""
    every = windows(docs, least_chars)
    repeated = every.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h1", "h2")
    hits = every.join(repeated, ["h1", "h2"])
    place = F.struct("_id", "_th", "pos")
    first = hits.groupBy("h1", "h2").agg(F.min(place).alias("first"))
    later = hits.join(first, ["h1", "h2"]).where(place > F.col("first"))
    same = F.col("_id").eqNullSafe(F.col("first")["_id"]) & (F.col("_th") == F.col("first")["_th"])
    start = F.when(same, F.greatest("pos", F.col("first")["pos"] + 3)).otherwise(F.col("pos"))
    spans = later.select("_id", "_th", start.alias("s"), (F.col("pos") + 2).alias("e")).where("s <= e")
    merged = spans.groupBy("_id", "_th").agg(F.collect_set(F.struct("s", "e")).alias("_spans"))
    positions = F.array_sort(F.array_distinct(F.flatten(F.transform("_spans", lambda x: F.sequence(x["s"], x["e"])))))
    return merged.select("_id", "_th", positions.alias("_covered"))


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", sentences: bool = True,
                least_chars: int = 0, names: tuple[str, str] = ("n_lines", "n_removed")) -> DataFrame:
    """``docs`` with its text less the covered lines, and how many lines it had and lost."""
    base = without(docs, *names)
    text = F.col(f"`{text_col}`").cast("string")
    keyed = base.withColumns({"_id": F.col(f"`{id_col}`"), "_th": F.xxhash64(text)})
    cut = keyed.select("_id", "_th", lines_of(F.coalesce(text, F.lit("")), sentences).alias("_lines"))
    covered = covered_lines(cut, least_chars).withColumnsRenamed({"_id": "_cid", "_th": "_cth"})
    joined = keyed.join(covered, F.col("_id").eqNullSafe(F.col("_cid")) & (F.col("_th") == F.col("_cth")), "left")
    lines = lines_of(text, sentences)
    fence = F.concat(F.array(F.lit(-1)), F.col("_covered"), F.array(F.size(lines)))
    kept = F.transform(F.sequence(F.lit(0), F.size("_covered")),
                       lambda i: F.slice("_l", F.get("_f", i) + 2, F.get("_f", i + 1) - F.get("_f", i) - 1))
    out = joined.withColumns({"_l": lines, "_f": F.when(F.col("_covered").isNotNull(), fence)})
    new = F.when(F.col("_covered").isNull(), text).otherwise(F.array_join(F.flatten(kept), ""))
    return out.select(*[new.alias(c) if c == text_col else F.col(f"`{c}`") for c in base.columns],
                      F.coalesce(F.size("_l"), F.lit(0)).alias(names[0]),
                      F.coalesce(F.size("_covered"), F.lit(0)).alias(names[1]))
