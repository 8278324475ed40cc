import numpy as np

import corpus_pipeline as cp

from .helpers import EDGES, documents
from .test_parity_join import brute as components_of
from .test_suffix_dedup import brute as without_repeats


def test_stages_on_a_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in cp.STAGES[:4]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        rows, before = {r.doc_id: r for r in out.collect()}, {r.doc_id: r for r in docs.collect()}
        texts = [(i, r.text) for i, r in before.items()]
        if name == "near_duplicates":
            assert set(rows) == {c for _, c in components_of(texts).values()}
        elif name == "repeats":
            want = {i: kept.decode("utf-8", "ignore") for i, _, _, kept in without_repeats(texts, cp.REPEAT_BYTES)}
            assert {i: r.text for i, r in rows.items()} == {i: t for i, t in want.items() if t or not before[i].text}
            assert all(r.n_chars == len(r.text) for i, r in rows.items() if r.text != before[i].text)
        else:
            assert all(rows[i] == before[i] for i in rows) and 0.8 * len(before) < len(rows) <= len(before)
        docs = out
    last = cp.STAGES[4][1](spark, docs, sf).collect()
    assert {r.doc_id for r in last} == set(rows)


def test_run(spark, sf):
    got = cp.run(spark, sf)
    total = {}
    for r in got.collect():
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
        assert r.length > 0
    assert len(total) > 100 and np.min(list(total.values())) >= 1


def test_edges(spark, sf):
    docs = documents(spark, EDGES + EDGES[6:8])
    for name, stage in cp.STAGES[:4]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns
        assert {1, 2, 3, 4} <= {r.doc_id for r in out.collect()}
        assert stage(spark, documents(spark, []), sf).count() == 0
        if name == "near_duplicates":
            assert [r.doc_id for r in out.where("doc_id in (7, 8)").collect()] == [7]
        docs = out


def test_short_passages_are_cut(spark, sf):
    """Passages of 51 to 60 words, many below 400 bytes, are all found."""
    r = np.random.default_rng(2)
    words = ["".join(r.choice(list("abcdefghilmnoprstu"), r.integers(3, 8))) for _ in range(4000)]
    say = lambda n: " ".join(r.choice(words, n))        # noqa: E731
    rows, passages = [], []
    for k in range(60):
        passages.append(say(51 + k % 10))
        rows += [(2 * k + j, f"{say(40)} {passages[-1]} {say(30)}") for j in range(2)]
    rows += [(1000 + k, say(120)) for k in range(60)]
    assert sum(len(p) < 400 for p in passages) > 50 and min(map(len, passages)) > cp.REPEAT_BYTES
    got = {x.doc_id: x.text for x in cp.repeats(spark, documents(spark, rows), sf).collect()}
    assert all(got[i] == t for i, t in rows if i >= 1000)
    for i, t in rows:
        if i < 1000:
            assert passages[i // 2] not in got[i] and len(got[i]) < len(t) - len(passages[i // 2]) + 40
            assert t.startswith(got[i][:150]) and t.endswith(got[i][-100:])
