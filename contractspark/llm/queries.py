"""The registered queries of this subpackage: each applies one operator to its whole table, with production parameters."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractspark.llm import content_sort, decontaminate, filter_audit, imatch, jaccard, line_dedup, packing, prefix_trie, quality, secrets_scan, sharding, toxicity, url_filter
from contractspark.llm.common import bounded_batches, held_out, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def registered(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        bounded_batches(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


@registered
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return (toxicity.score(docs, model, keep=["doc_id"])
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"))


@registered
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    items = F.col("contamination")["items"]
    return found.select(
        "doc_id", F.col("contamination")["n_words"].alias("n_words"), decontaminate.n_hit().alias("n_hit"),
        F.size(items).cast("long").alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        decontaminate.is_contaminated().alias("contaminated"), F.col("contamination")["spans"].alias("spans"))


def word_bpe_path() -> str:
    """The installed vocabulary that the packing queries name; its place is the operator's parameter."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@registered
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), word_bpe_path())


@registered
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


ORACLE["op6_line_dedup"] = """
WITH cut AS (
  SELECT doc_id, text, list_filter(string_split(replace(replace(replace(replace(text, chr(10), chr(10) || chr(1)),
    '. ', '. ' || chr(1)), '! ', '! ' || chr(1)), '? ', '? ' || chr(1)), chr(1)), lambda x: x <> '') AS l
  FROM documents),
w AS (
  SELECT doc_id, unnest(range(0, len(l) - 2)) AS pos, l FROM cut WHERE len(l) >= 3),
k AS (
  SELECT doc_id, pos, [rtrim(rtrim(l[pos + 1], chr(10)), ' '), rtrim(rtrim(l[pos + 2], chr(10)), ' '),
    rtrim(rtrim(l[pos + 3], chr(10)), ' ')] AS key FROM w),
f AS (
  SELECT doc_id, pos, first_value(doc_id) OVER o AS d0, first_value(pos) OVER o AS p0
  FROM k WINDOW o AS (PARTITION BY key ORDER BY doc_id, pos)),
c AS (
  SELECT DISTINCT doc_id, unnest(range(CASE WHEN doc_id = d0 THEN greatest(pos, p0 + 3) ELSE pos END, pos + 3)) AS pos
  FROM f WHERE doc_id <> d0 OR pos <> p0),
g AS (SELECT doc_id, list(pos) AS gone FROM c GROUP BY doc_id)
SELECT cut.doc_id, CAST(len(l) AS INTEGER) AS n_lines, CAST(coalesce(len(gone), 0) AS INTEGER) AS n_removed,
  sha256(CASE WHEN gone IS NULL THEN text ELSE array_to_string(list_filter(l, lambda x, i: NOT list_contains(gone, i - 1)), '') END) AS text_sha256
FROM cut LEFT JOIN g USING (doc_id)
"""


@registered
def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


@registered
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("text_crc32", F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
    out = sharding.shard_by_bytes(docs, keep=["doc_id", "text_crc32"])
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


#: The rules that the URL query is asked to apply.
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


@registered
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), table(spark, sf_dir, "labels"), URL_RULES)


@registered
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    found = secrets_scan.scan(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                              public_tokenizers.PATTERN, keep=["doc_id"])
    of = lambda kind: F.size(F.filter("secrets", lambda x: x["kind"] == kind)).cast("long")
    text = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    base = F.filter("secrets", lambda x: x["kind"] != "random")
    return found.select("doc_id", of("assign").alias("n_assign"), of("access").alias("n_access"), of("hex").alias("n_hex"),
                        F.sha2(text(base), 256).alias("base_sha256"), text(F.col("secrets")).alias("spans"))


@registered
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    space = quality.train(docs, table(spark, sf_dir, "labels"))
    return (quality.score(docs, space, keep=["doc_id"])
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"))


@registered
def op7_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(table(spark, sf_dir, "documents"))


@registered
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE["op11_filter_audit"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
e AS (SELECT *, doc_id > min(doc_id) OVER (PARTITION BY t) AS copy FROM d),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    (CASE WHEN len(w) < 200 THEN 'A' ELSE '' END) || (CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END)
    || (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 'C' ELSE '' END)
    || (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END) || (CASE WHEN copy THEN 'E' ELSE '' END) AS fails
  FROM e LEFT JOIN l USING (doc_id)),
c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
p AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step, filter_order[step] AS own, filter_order[1:step - 1] AS before FROM p, (SELECT unnest(range(1, 6)) AS step)),
r AS (
  SELECT part, filter_order, step, own, n, good, toxic, contains(fails, own) AS has, fails = own AS alone,
    len(list_intersect(string_split(before, ''), string_split(fails, ''))) > 0 AND before <> '' AND fails <> '' AS earlier
  FROM c, s),
g AS (
  SELECT part, filter_order, step, own, sum(CASE WHEN has OR earlier THEN 0 ELSE n END) AS kept, sum(CASE WHEN has AND NOT earlier THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN has AND earlier THEN n ELSE 0 END) AS redundant, sum(CASE WHEN alone THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN has AND NOT earlier THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN has AND NOT earlier THEN toxic ELSE 0 END) AS toxic_lost
  FROM r GROUP BY part, filter_order, step, own)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM g
"""


@registered
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = prefix_trie.conversation_paths(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie_nodes(prefix_trie.with_shared_heads(paths))


#: DuckDB has no crc32: bytes go through a table that the polynomial gives.
ORACLE["op12_prefix_trie"] = r"""
WITH crc AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(CAST(i AS BIGINT), range(8)), lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v
    FROM range(256) AS r(i))),
own AS (
  SELECT conv_id, list(struct_pack(role := coalesce(role, ''), body := coalesce(text, ''))
    ORDER BY turn NULLS FIRST, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (
  SELECT conv_id, turns, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 4 AS h FROM own, crc),
built AS (
  SELECT h.conv_id, list_concat(coalesce(o.turns[1:h], []), h.turns[h + 1:]) AS turns
  FROM h LEFT JOIN own o ON o.conv_id = h.conv_id - h.conv_id % 20),
pre AS (
  SELECT conv_id, d, turns[1:d] AS path, len(turns) AS n_turns,
    CASE WHEN d = 0 THEN 0 ELSE len(list_filter(string_split_regex(turns[d].body, '[\x20\x09-\x0D]+'), lambda x: x <> '')) END AS words
  FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM built)),
node AS (
  SELECT path, d, min(conv_id) AS conv_id, count(*) AS n, any_value(words) AS words,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n_turns = d), '') AS ends
  FROM pre GROUP BY path, d),
kid AS (SELECT path[1:d - 1] AS path, d - 1 AS d, count(*) AS n_children FROM node WHERE d > 0 GROUP BY 1, 2),
up AS (
  SELECT path[1:a] AS path, a AS d, sum((n - 1) * words) AS saved, sum(leaf) AS n_leaves
  FROM (SELECT node.path, node.d, n, words, CASE WHEN n_children IS NULL THEN 1 ELSE 0 END AS leaf, unnest(range(0, node.d + 1)) AS a
        FROM node LEFT JOIN kid ON node.d = kid.d AND node.path = kid.path) GROUP BY 1, 2)
SELECT node.conv_id, CAST(node.d AS BIGINT) AS depth, above.conv_id AS parent_conv_id, node.n AS n_convs, CAST(coalesce(n_children, 0) AS BIGINT) AS n_children,
  CAST(up.n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(node.ends) AS ends_sha256
FROM node JOIN up ON node.d = up.d AND node.path = up.path LEFT JOIN kid ON node.d = kid.d AND node.path = kid.path
LEFT JOIN node above ON node.d > 0 AND above.d = node.d - 1 AND above.path = node.path[1:node.d - 1]
"""


@registered
def op13_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort.mark_copies(table(spark, sf_dir, "documents"), keep=["doc_id"])


ORACLE["op13_content_sort"] = r"""
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
"""
