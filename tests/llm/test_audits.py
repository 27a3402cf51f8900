"""The filter audit, the prefix trie and the content sort against plain Python and SQL, odd rows, small limits."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import pytest

from contractspark.llm import content_sort, filter_audit, prefix_trie
from contractspark.llm.queries import ORACLE, QUERIES

from . import cases
from ..conftest import SF_SMALL
from ..oracle import compare, duck

LABELS = "doc_id long, quality int, toxic int"
TURNS = "conv_id long, turn long, role string, text string"
blanks = re.compile(r"[\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", ["op11_filter_audit", "op12_prefix_trie", "op13_content_sort"])
def test_query_equals_sql(spark, name):
    ok, rows, _, detail = compare(spark, duck(SF_SMALL), name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert ok and rows > 0, detail


# ---- exact dedup by content sort ----------------------------------------------------------------------------


def plain_copies(docs):
    """A multiset of (id, keep_id, group size, kept, digest)."""
    groups = defaultdict(list)
    for i, t in docs:
        groups[blanks.sub(" ", t or "")].append(i)
    out = Counter()
    for text, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i))
        for k, i in enumerate(ids):
            out[i, ids[0], len(ids), k == 0, hashlib.sha256(text.encode()).hexdigest()] += 1
    return out


def as_counter(df):
    return Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect())


def test_content_sort_odd_rows(spark):
    docs = cases.odd_texts() + [(None, prose) for prose in ("only nulls", "only  nulls")] + [(20, "a b"), (21, "a\t\n b"), (22, "a b"), (23, " a b"), (-5, "one")]
    assert as_counter(content_sort.mark_copies(cases.documents(spark, docs))) == plain_copies(docs)


@pytest.mark.parametrize("part_rows, part_bytes", [(1, 1 << 20), (3, 1 << 20), (10_000, 64), (10_000, 64 << 20)])
def test_content_sort_hot_group_over_shards(spark, part_rows, part_bytes):
    """A group of a third of all rows, cut into shards and parts, is one group; so are texts that differ after byte 32."""
    rng = random.Random(part_rows)
    head = "the same first thirty-two bytes and more "
    docs = [(i, head if i % 3 == 0 else head + str(rng.randrange(40)) if i % 3 == 1 else f"text {rng.randrange(30)}") for i in range(600)]
    rng.shuffle(docs)
    df = cases.documents(spark, docs).repartition(7)
    assert as_counter(content_sort.mark_copies(df, part_rows=part_rows, part_bytes=part_bytes)) == plain_copies(docs)


def test_content_sort_empty_and_clashing(spark):
    assert content_sort.mark_copies(cases.documents(spark, [])).count() == 0
    docs = [(1, "a  b"), (2, "a b"), (3, "c")]
    df = cases.clashing(cases.documents(spark, docs), "keep_id", "kept", "_text", "_hash", "_shard")
    out = content_sort.mark_copies(df)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "_text", "_hash", "_shard", *content_sort.RESULT]
    assert as_counter(out) == plain_copies(docs)
    kept = content_sort.drop_copies(df)
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, "a  b"), (3, "c")]


# ---- filter interaction audit -------------------------------------------------------------------------------


def plain_audit(docs, labels):
    """{(part, order, step): counts}, document by document and order by order."""
    seen, good, toxic = defaultdict(set), defaultdict(int), defaultdict(int)
    for i, _, t in docs:
        if i is not None:
            seen[t or ""].add(i)
    for i, q, x in labels:
        good[i], toxic[i] = good[i] | (q == 1), toxic[i] | (x == 1)
    rows = []
    for i, part, t in docs:
        t = t or ""
        words = [w for w in blanks.split(t) if w]
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and min(seen[t]) < i}
        rows.append((part or "", {x for x, f in fails.items() if f}, good[i] if i is not None else 0, toxic[i] if i is not None else 0))
    out, shapley = {}, Counter()
    for part in {r[0] for r in rows}:
        own = [r[1:] for r in rows if r[0] == part]
        for order in permutations("ABCDE"):
            before = set()
            for step, f in enumerate(order, 1):
                gone = [r for r in own if f in r[0] and not r[0] & before]
                out[part, "".join(order), step] = [sum(not r[0] & (before | {f}) for r in own), len(gone), sum(f in r[0] and bool(r[0] & before) for r in own),
                                                   sum(r[0] == {f} for r in own), sum(r[1] for r in gone), sum(r[2] for r in gone)]
                shapley[part, f] += len(gone)
                before = before | {f}
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audit_rows(df):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in df.collect()}


def audited(spark, docs, labels, **extra):
    frame = spark.createDataFrame([(i, t, None, s, None) for i, s, t in docs], cases.DOCS)
    return filter_audit.audit(frame.withColumns(extra) if extra else frame, spark.createDataFrame(labels, LABELS))


def test_audit_equals_plain_python(spark):
    rng = random.Random(3)
    texts = [cases.prose(k, n) + tail for k in range(4) for n in (50, 199, 200, 260) for tail in ("", "SHOUT " * 60, " 100 % ")] + ["", " \n", "É" * 300, "a " * 250, None]
    docs = [(i, rng.choice(["web", "web", "book", None, ""]), rng.choice(texts)) for i in range(400)]
    docs += [(None, "web", texts[0]), (None, "web", texts[0]), (7, "web", "twice"), (7, "web", "twice"), (7, "book", "other"), (9000, "web", "twice")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 400, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1)]
    got = audit_rows(audited(spark, docs, labels))
    assert got == plain_audit(docs, labels)
    assert len(got) == 3 * 600 and any(v[4] for v in got.values()) and any(v[5] for v in got.values())


def test_audit_hot_group_is_salted(spark, monkeypatch):
    """With every repeated hash taken as a hot one the result is the same."""
    docs = [(i, "web", "the same words " * 80 if i % 3 else f"other {i % 10}") for i in range(3300)]
    expect = plain_audit(docs, [])
    assert audit_rows(audited(spark, docs, [(1, 1, 0)])) .keys() == expect.keys()
    assert {k: v[:4] for k, v in audit_rows(audited(spark, docs, [(1, 1, 0)])).items()} == {k: v[:4] for k, v in expect.items()}


def test_audit_empty_and_clashing(spark):
    from pyspark.sql import functions as F

    assert audit_rows(audited(spark, [], [])) == {}
    docs = [(1, "web", "a"), (2, "web", "a"), (3, None, None)]
    assert audit_rows(audited(spark, docs, [], _id=F.lit("x"), _bits=F.lit("y"), part=F.lit("z"), failures=F.lit(1))) == plain_audit(docs, [])


# ---- prefix trie --------------------------------------------------------------------------------------------


def plain_trie(paths):
    """Rows of the trie's nodes from {id: [(role, text), ..]}, prefix by prefix."""
    members = defaultdict(list)
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    own = {p: (len(m) - 1) * (len([w for w in blanks.split(p[-1][1]) if w]) if p else 0) for p, m in members.items()}
    kids = Counter(p[:-1] for p in members if p)
    saved, leaves = Counter(), Counter()
    for p in members:
        for d in range(len(p) + 1):
            saved[p[:d]] += own[p]
            leaves[p[:d]] += not kids[p]
    out = Counter()
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(paths[c]) == len(p))
        out[min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()] += 1
    return out


def rebuilt(turns):
    """{id: turns} with the shared heads of the query."""
    own = defaultdict(list)
    for c, n, role, text in turns:
        if c is not None:
            role, text = role or "", text or ""
            content = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[c].append((n is not None, n or 0, content, role, text))
    own = {c: [x[3:] for x in sorted(t)] for c, t in own.items()}
    out = {}
    for c in own:
        h, donor = zlib.crc32(str(c).encode()) % 4, c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = own.get(donor, [])[:h] + own[c][h:]
    return out


def some_turns(seed, n=300):
    rng, out = random.Random(seed), []
    for c in rng.sample(range(-40, 3 * n), n):
        depth = rng.choice([1, 2, 2, 3, 5, 9, 40 if c % 7 == 0 else 4])
        hot = rng.random() < 0.4
        for d in range(depth):
            out.append((c, d, "user" if d % 2 == 0 else "assistant", "hot words " * (d % 3) if hot else f"say {rng.randrange(3)} of {d}"))
    out += [(5000, None, None, None), (5000, None, "user", "null turn"), (5000, 3, None, "x y"), (5000, 3, "user", ""), (None, 1, "user", "nobody"), (5001, 0, "a", "b"), (5001, 0, "a", "b")]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("shards", [1, 2, 7, 40])
def test_trie_equals_plain_python(spark, shards):
    turns = some_turns(shards)
    frame = spark.createDataFrame(turns, TURNS).repartition(5)
    got = prefix_trie.trie_nodes(prefix_trie.with_shared_heads(prefix_trie.conversation_paths(frame)), shards=shards)
    assert Counter(tuple(r[c] for c in prefix_trie.RESULT) for r in got.collect()) == plain_trie(rebuilt(turns))


def test_trie_small_chunks_and_skeletons(spark, monkeypatch):
    """A hot conversation over many shards: its ids come in several chunks; a skeleton beyond its bound is thinned."""
    turns = [(c, d, "user", "hi there" if c % 3 else f"hi {c}") for c in range(400) for d in range(4)]
    expect = plain_trie({c: [("user", "hi there" if c % 3 else f"hi {c}")] * 4 for c in range(400)})
    frame = spark.createDataFrame(turns, TURNS).repartition(5)
    monkeypatch.setattr(prefix_trie, "CHUNK", 60)
    assert Counter(tuple(r[c] for c in prefix_trie.RESULT) for r in prefix_trie.trie_nodes(prefix_trie.conversation_paths(frame), shards=12).collect()) == expect
    monkeypatch.setattr(prefix_trie, "SKELETON", 9)
    assert Counter(tuple(r[c] for c in prefix_trie.RESULT) for r in prefix_trie.trie_nodes(prefix_trie.conversation_paths(frame), shards=12).collect()) == expect


def test_trie_empty_and_clashing(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], TURNS)).count() == 0
    assert prefix_trie.prefix_trie(spark.createDataFrame([(None, 1, "a", "b")], TURNS)).count() == 0
    frame = cases.clashing(spark.createDataFrame([(1, 0, "a", "b c"), (2, 0, "a", "b c")], TURNS), "path", "words", "t", "shard")
    assert Counter(tuple(r) for r in prefix_trie.prefix_trie(frame).collect()) == plain_trie({1: [("a", "b c")], 2: [("a", "b c")]})


def test_skeleton_is_the_trie_of_the_splitters():
    a, b, c = (bytes([x]) * 16 for x in (1, 2, 3))
    skeleton = prefix_trie.Skeleton([a, a + b, a + b, a + c], [[1], [1, 2], [1, 2], [1, 3]])
    assert skeleton.parent == [-1, 0, 1, 1] and skeleton.words == [0, 1, 2, 3] and skeleton.depth == [0, 1, 2, 2]
    assert list(skeleton.on(1, a + b + c)) == [0, 1, 2] and list(skeleton.on(4, c)) == [0]
