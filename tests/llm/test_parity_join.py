import re

import numpy as np
import pytest

from timewise.llm.components import components
from timewise.llm.parity_join import chunk_keys, near_duplicates
from timewise.llm.textblock import shingle_sets

from .helpers import EDGES, documents, random_texts, same_as_duckdb


def sets_of(rows):
    out = {}
    for i, t in rows:
        w = re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode().lower())
        out[i] = {tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    return out


def brute(rows):
    sets, ids = sets_of(rows), [i for i, _ in rows]
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and sets[a] and sets[b] and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("seed,crowd", [(1, 24), (2, 0)])
def test_brute_force(spark, seed, crowd):
    rows = list(enumerate(random_texts(seed, 90), 100))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(documents(spark, rows), crowd=crowd).collect()}
    assert got == brute(rows)


@pytest.mark.parametrize("crowd", [0, 3])
def test_crowded_way_on_longer_texts(spark, crowd):
    """Weight-2 chunks, later salts and unequal last salts: near copies of
    100 to 300 words, chained by small edits, around a shared passage."""
    r = np.random.default_rng(11)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = " ".join(r.choice(vocabulary, 60))
    rows = []
    for k in range(9):
        words = list(r.choice(vocabulary, int(r.integers(100, 300))))
        for _ in range(7):
            words = list(words)
            for at in r.integers(0, len(words), int(r.integers(1, 1 + len(words) // 60))):
                words[at] = str(r.choice(vocabulary))
            rows.append((len(rows), " ".join(words) + (" " + passage if k % 3 == 0 else "")))
    rows += [(100 + k, passage + " " + " ".join(r.choice(vocabulary, 20 + k))) for k in range(8)]
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in near_duplicates(documents(spark, rows), crowd=crowd).collect()}
    assert got == brute(rows)


def test_edges(spark):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(documents(spark, EDGES)).collect()}
    assert got == brute(EDGES)
    assert near_duplicates(documents(spark, [])).count() == 0
    assert near_duplicates(documents(spark, EDGES[:3])).count() == 3


def test_duckdb(spark, sf):
    same_as_duckdb(spark, sf, "op10_parity_join")


def test_linked_sets_share_a_key():
    """The pigeonhole, at the worst difference that still links."""
    r = np.random.default_rng(5)
    for n in [1, 2, 4, 5, 9, 10, 30, 63, 64, 65, 100, 127, 128, 250, 999, 4000]:
        for _ in range(4):
            both = r.integers(1, 2 ** 63, n, np.uint64)
            only = r.integers(1, 2 ** 63, n, np.uint64)
            for extra_a in {0, n // 8, n // 4}:
                extra_b = n // 4 - extra_a
                a, b = np.sort(np.concatenate([both, only[:extra_a]])), np.sort(np.concatenate([both, only[extra_a:extra_a + extra_b]]))
                if 100 * n >= 80 * (n + extra_a + extra_b):
                    assert np.intersect1d(chunk_keys(np.unique(a), 80), chunk_keys(np.unique(b), 80)).size


def test_shingle_sets_match_plain_python():
    texts = random_texts(9, 40) + ["", " ", "A b C d E f", "x"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offs = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    got = [len(s) for s in shingle_sets(data, offs)]
    assert got == [len(s) for s in sets_of(enumerate(texts)).values()]


def test_components(spark):
    e = [(i, i + 1) for i in range(1, 40)] + [(100, 50), (50, 100), (7, 7), (None, 3), (200, 300), (300, 400), (400, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(e, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 50: 50, 100: 50, 200: 200, 300: 200, 400: 200}
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_a_set_without_spare_keys_is_compared():
    """Unequal last salts: the pair is kept if the set with the lesser salt is
    poor, whether or not the other has keys to spare."""
    import pyarrow as pa

    from timewise.llm.parity_join import _close, dense_sketch
    s = np.arange(100, dtype=np.uint64)
    for last, poor, kept in [((0, 1), (1, 0), True), ((0, 1), (0, 1), False), ((0, 0), (1, 0), False), ((0, 0), (1, 1), True), ((2, 1), (0, 1), True)]:
        t = pa.table({"rep": [1, 2], "component": [1, 2], "n_shingles": [100, 100], "block": [0, 0], "lo": [0, 0], "hi": [0, 0],
                      "sketch": [dense_sketch(s)] * 2, "last": pa.array(last, pa.int32()), "poor": pa.array(poor, pa.int32())})
        assert (_close(80)(t).num_rows == 1) == kept
