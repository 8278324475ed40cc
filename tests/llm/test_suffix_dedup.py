import numpy as np
import pytest

from timewise.llm.queries import op4_suffix_dedup
from timewise.llm.suffix_dedup import Suffixes, remove_repeats

from .helpers import EDGES, documents, random_texts


def brute(rows, length):
    bodies = [(t or "").encode() for _, t in rows]
    count = {}
    for b in bodies:
        for s in range(len(b) - length + 1):
            count[b[s:s + length]] = count.get(b[s:s + length], 0) + 1
    out = []
    for (i, _), b in zip(rows, bodies):
        gone = np.zeros(len(b) + 1, bool)
        for s in range(len(b) - length + 1):
            if count[b[s:s + length]] > 1:
                gone[s:s + length] = True
        edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int)])))
        out.append((i, len(b), [(int(x), int(y)) for x, y in zip(edge[::2], edge[1::2])], b"".join(bytes([c]) for c, g in zip(b, gone) if not g)))
    return sorted(out)


def ours(df, length, **kw):
    return sorted((r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in remove_repeats(df, length=length, **kw).collect())


@pytest.mark.parametrize("seed,length,hot", [(3, 30, 8192), (4, 30, 2), (5, 11, 8192), (6, 50, 8192)])
def test_brute_force(spark, seed, length, hot):
    rows = list(enumerate(random_texts(seed, 80, vocabulary=60), 10))
    assert ours(documents(spark, rows), length, hot=hot) == brute(rows, length)


def test_edges(spark):
    rows = EDGES + [(20, "b" * 900), (21, "b" * 400), (22, "xyz" * 400), (23, "q" + "xyz" * 150 + "r"), (24, "é" * 500)]
    assert ours(documents(spark, rows), 400) == brute(rows, 400)
    assert ours(documents(spark, []), 400) == []


@pytest.mark.parametrize("hot", [8192, 2])
def test_a_row_given_twice(spark, hot):
    """As many rows out as in; equal rows of one id repeat each other."""
    texts = random_texts(7, 30, vocabulary=60)
    rows = list(enumerate(texts, 10)) + [(200, "p" + texts[0] + "q"), (300, "short"), (300, "short")]
    rows += [rows[0], rows[0], rows[5], rows[30]]
    assert ours(documents(spark, rows), 30, hot=hot) == brute(rows, 30)


def test_mergesort_orders_suffixes():
    r = np.random.default_rng(2)
    data = r.integers(97, 99, 4000).astype(np.uint8)
    at = np.sort(r.choice(3900, 300, False))
    s = Suffixes(data, at, np.minimum(at, 50), np.full(len(at), 100))
    order = s.mergesort(np.array([0, 100]), np.array([100, 200]), False)
    raw = data.tobytes()
    for a, b in ((0, 100), (100, 300)):
        keys = [raw[at[i]:at[i] + 100] for i in order[a:b]]
        assert sorted(order[a:b]) == list(range(a, b)) and keys == sorted(keys)
    back = s.mergesort(np.array([0]), np.array([300]), True)
    keys = [raw[at[i] - min(at[i], 50):at[i]][::-1] for i in back]
    assert keys == sorted(keys)


def test_shorter_passages_are_counted(spark):
    """Bytes in repeated passages below the length are told, but stay."""
    rows = list(enumerate(random_texts(8, 60, vocabulary=60), 100)) + EDGES
    df = documents(spark, rows + [rows[0]])
    got = remove_repeats(df, length=50, passage=30).collect()
    assert sorted((r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in got) == brute(rows + [rows[0]], 50)
    want = sorted((i, sum(b - a for a, b in spans)) for i, _, spans, _ in brute(rows + [rows[0]], 30))
    assert sorted((r.doc_id, r.n_repeated) for r in got) == want
    assert any(r.n_repeated and not r.spans for r in got)


def test_query_tells_passages_of_51_words(spark, tmp_path):
    r = np.random.default_rng(3)
    say = lambda n: " ".join("".join(r.choice(list("abcdeghilmnorstu"), r.integers(4, 7))) for _ in range(n))        # noqa: E731
    passage = say(51)
    assert 220 < len(passage) < 390
    rows = [(1, f"{say(40)} {passage} {say(30)}"), (2, f"{passage} {say(60)}"), (3, say(130)), (4, say(20)), (None, passage), (6, None)]
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = {x.doc_id: x for x in op4_suffix_dedup(spark, str(tmp_path)).collect()}
    assert all(x.n_removed == x.n_spans == 0 for x in got.values()) and len(got) == len(rows)
    assert {i for i, x in got.items() if x.n_repeated} == {1, 2} and len(passage) <= got[1].n_repeated <= len(passage) + 4
