"""Learned operators, by held-out rows and small fixtures, and the pipeline against a brute-force version."""

import gc
import tracemalloc
import weakref
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from contractspark.llm import quality, toxicity
from contractspark.llm.common import held_out, per_process, table
from contractspark.llm.queries import QUERIES, word_bpe_path

from . import cases
from ..conftest import SF_SMALL

SF = "/root/testdata/sf0.01"


def test_held_out_fold(spark):
    got = {r[0]: r[1] for r in spark.createDataFrame([(i,) for i in (None, 0, 7, 10 ** 12)], "i long").select("i", held_out(F.col("i"))).collect()}
    assert got == {i: i is not None and zlib.crc32(str(i).encode()) % 5 == 0 for i in got}


def judged(spark, name, label):
    got = QUERIES[name](spark, SF).toPandas()
    assert len(got) == table(spark, SF, "documents").count() and got["score"].between(0, 1).all()
    both = got.merge(pd.read_parquet(f"{SF}/labels.parquet"), on="doc_id")
    return both[both["held_out"]], label


def test_toxicity_held_out(spark):
    x, label = judged(spark, "op8_toxicity", "toxic")
    assert x[x[label] == 1]["predicted"].mean() >= 0.6 and x[x[label] == 0]["predicted"].mean() <= 0.03


def test_quality_held_out(spark):
    x, label = judged(spark, "op3_quality", "quality")
    assert x[x[label] == 1]["predicted"].mean() >= 0.99 and (x["predicted"] == x[label]).mean() >= 0.95


def test_factorization_machine_learns_a_pair():
    """Neither word alone is toxic, both together are: additive weights can't tell them apart."""
    rng, texts, labels = np.random.default_rng(3), [], []
    for k in range(1600):
        a, b = k % 2, (k // 2) % 2
        filler = [f"w{rng.integers(8)}" for _ in range(3)]
        texts.append(" ".join([*filler, *(["insulting"] if a else ["friendly"]), *(["somegroup"] if b else ["nobody"])]))
        labels.append(a * b)
    m = toxicity.fit(texts, labels, z=0.0, epochs=40)
    used = (m.weights != 0) | (m.factors != 0).any(axis=1)
    s = m.score(*toxicity.term_buckets(["insulting somegroup w1", "insulting nobody w1", "friendly somegroup w1", "friendly nobody w1"], m.bits, toxicity.TermMemory(m.bits, used)))
    assert s[0] > 0.5 > max(s[1:])


def test_toxicity_training_holds_few_bytes_a_term():
    rng = np.random.default_rng(2)
    words = np.array(["".join(map(chr, x)) for x in rng.integers(97, 123, (4000, 8))])
    texts = [" ".join(words[rng.integers(4000, size=250)]) for _ in range(1500)]
    entries = len(toxicity.term_buckets(texts, 14)[0])
    tracemalloc.start()
    toxicity.fit(texts, [int(words[k % 40] in x) for k, x in enumerate(texts)], 14, epochs=1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 24 * entries, (peak, entries)


def test_toxicity_training_takes_rows_by_id_as_text_then_text(spark):
    rows = [(i % 190, None if i % 17 == 0 else f"word{i % 7} other{i % 11} \U0001f600{i % 3} \uffee{i % 5}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, int(i % 7 == 3)) for i in range(190)], "doc_id long, toxic int")
    used = sorted(((str(i), t or "", int(i % 7 == 3)) for i, t in rows if zlib.crc32(str(i).encode()) % 5))
    got, want = toxicity.train(docs, labels, bits=10), toxicity.fit([x[1] for x in used], [x[2] for x in used], 10)
    assert got.bias == want.bias and (got.weights == want.weights).all() and (got.factors == want.factors).all() and got.factors.any()


def test_worker_keeps_the_object_of_one_key():
    first = per_process(("one",), dict)
    assert per_process(("one",), dict) is first
    ref = weakref.ref(per_process(("held",), type("Held", (), {})))
    per_process(("two",), dict)
    gc.collect()
    assert ref() is None and per_process(("one",), dict) is not first


def test_margins_equal_pair_by_pair_sums():
    """The margin is the bias, the weights of a text's terms, and each pair's product of factors by the number of terms."""
    rng = np.random.default_rng(5)
    bits, w, v = 8, rng.normal(size=256).astype(np.float32), rng.normal(size=(256, 4)).astype(np.float32)
    w[::3], v[::3] = 0, 0
    m = toxicity.FactorizationMachine(bits, 0.3, w, v)
    texts = ["one two three", "", None, "one one one", cases.prose(3, 200), "Übel über alles", "x"]
    for memory in (None, toxicity.TermMemory(bits, (w != 0) | (v != 0).any(axis=1), most=3)):  # with and without the zero terms
        got = m.score(*toxicity.term_buckets(texts, bits, memory))
        for text, s in zip(texts, got):
            words = set(toxicity.WORD.findall((text or "").lower()))
            terms = sorted({zlib.crc32(t.encode()) & 255 for word in words for t in toxicity.word_terms(word)})
            if memory is not None:
                terms = [t for t in terms if w[t] or v[t].any()]
            pairs = sum(float(v[a].astype(float) @ v[b].astype(float)) for k, a in enumerate(terms) for b in terms[k + 1:])
            margin = 0.3 + sum(float(w[t]) for t in terms) + pairs / max(1, len(terms))
            assert abs(s - 1 / (1 + np.exp(-np.clip(margin, -30, 30)))) < 1e-4


@pytest.mark.parametrize("label", [lambda a, b: a * b, lambda a, b: a ^ b])
def test_factorization_machine_learns_pairs_by_default(label):
    """With the defaults, both together, and one or the other only: in the latter no word alone says anything."""
    rng, texts, labels = np.random.default_rng(3), [], []
    for k in range(1600):
        a, b = k % 2, (k // 2) % 2
        texts.append(" ".join([*(f"w{rng.integers(8)}" for _ in range(3)), ["friendly", "insulting"][a], ["nobody", "somegroup"][b]]))
        labels.append(label(a, b))
    m = toxicity.fit(texts, labels)
    used = (m.weights != 0) | (m.factors != 0).any(axis=1)
    four = [(a, b) for a in (0, 1) for b in (0, 1)]
    s = m.score(*toxicity.term_buckets([f"{['friendly', 'insulting'][a]} {['nobody', 'somegroup'][b]} w1" for a, b in four], m.bits, toxicity.TermMemory(m.bits, used)))
    assert [x > 0.5 for x in s] == [label(a, b) == 1 for a, b in four]


def test_votes_equal_plain_neighbours():
    rng = np.random.default_rng(1)
    texts = [cases.prose(k, 50) + "!" * int(rng.integers(5)) for k in range(60)]
    labels = [k % 2 for k in range(60)]
    made = quality.TermRows(64)
    rows = np.stack([made.row(t) for t in texts])
    space = quality.learn(texts, labels, (rows > 0).sum(0), 60, 16)
    got = space.votes(rows[:10], 5, 8.0)
    v = space.vectors_of(rows[:10])
    for x, s in zip(v, got):
        like = [float(x @ y) for y in space.vectors]
        best = sorted(range(60), key=lambda k: -like[k])[:5]
        w = np.maximum([like[k] for k in best], 0) ** 8.0
        assert abs(s - (w * [labels[k] for k in best]).sum() / w.sum()) < 1e-3
    assert space.votes(np.zeros((1, 64), np.float32), 5, 8.0)[0] == 0.5  # a text without words: the share of label 1


def test_learned_operators_take_odd_rows(spark):
    docs = cases.clashing(cases.documents(spark, cases.odd_texts()), "score", "predicted", "_text")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(3, 1, 0), (3, 0, 1), (None, 1, 1), (8, None, None), (6, 0, 0)], none.schema)
    for labels in (none, some):
        space, model = quality.train(docs, labels, max_rows=50), toxicity.train(docs, labels, bits=10)
        for out in (quality.score(docs, space), toxicity.score(docs, model)):
            got = out.collect()
            assert len(got) == len(cases.odd_texts()) and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in got)
            assert out.columns == [*cases.documents(spark, []).columns, "_text", "score", "predicted"]
    assert quality.score(docs.limit(0), space).count() == 0 and toxicity.score(docs.limit(0), model).count() == 0
    assert quality.train(docs.limit(0), some).votes(np.zeros((1, 1024), np.float32), 5, 8.0)[0] == 0.5


def test_pipeline_equals_brute_force(spark):
    """Every stage after the (separately tested) model, against plain Python over what the model kept."""
    docs = table(spark, SF_SMALL, "documents")
    kept = corpus_pipeline.drop_toxic(spark, docs, SF_SMALL)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    texts = cases.without_repeated_lines(rows)
    texts = {i: t for i, t in texts.items() if t or not dict(rows)[i]}
    near = cases.components(list(texts.items()), 5, 80, 100)
    texts = {i: t for i, t in texts.items() if near[i][1] == i}
    items = [(r.item_id, r.text) for r in table(spark, SF_SMALL, "benchmark").collect()]
    dirty = cases.contamination(list(texts.items()), items)
    texts = {i: t for i, t in texts.items() if not (dirty[i][1] and 20 * dirty[i][1] >= dirty[i][0])}

    out = corpus_pipeline.run(spark, SF_SMALL).toPandas()
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(word_bpe_path())
    coder.encode_special_tokens = True
    assert set(out["doc_id"]) == set(texts)
    for i, pieces in out.sort_values("start").groupby("doc_id"):
        ids = np.array([*coder.encode(texts[i], add_special_tokens=False).ids, 1], "<u4")
        assert pieces["length"].sum() == len(ids)
        assert [zlib.crc32(ids[s:s + n].tobytes()) for s, n in zip(pieces["start"], pieces["length"])] == pieces["ids_crc32"].tolist()


def test_pipeline_stages_take_odd_rows(spark, tmp_path):
    docs = cases.clashing(cases.documents(spark, cases.odd_texts()), "n_lines", "score", "contamination", "component_id")
    for name, rows in (("labels", [(3, 1, 0)]), ("benchmark", [(1, cases.prose(2, 20))])):
        spark.createDataFrame(rows, {"labels": "doc_id long, quality int, toxic int", "benchmark": "item_id long, text string"}[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    for frame in (docs, docs.limit(0)):
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, frame, str(tmp_path))
            if k < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == frame.columns, name
            n = out.count()
            assert n == 0 if frame is not docs else n > 0, name


def test_pipeline_keeps_one_row_of_each_group_of_copies(spark):
    """Repeated ids, null ids, and two texts under one id: exact rows."""
    a, b, c = (cases.prose(k, 60) for k in (1, 2, 3))
    docs = [(1, a), (1, a), (2, a), (None, a), (2, b), (3, b + "one"), (4, c), (4, c), (5, ""), (5, ""), (6, None), (None, "few words")]
    out = corpus_pipeline.drop_near_copies(spark, cases.documents(spark, docs), SF_SMALL)
    assert sorted((str(r.doc_id), r.text or "") for r in out.collect()) == sorted([("1", a), ("2", b), ("4", c), ("5", ""), ("5", ""), ("6", ""), ("None", "few words")])
