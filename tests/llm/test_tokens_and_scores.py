import math
import re
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from timewise.llm.lm_scoring import lm_scores
from timewise.llm.token_counts import allocate, byte_sections, line_sections, section_tokens

from .helpers import EDGES, documents

RANKS = P.path("byte_bpe_50k.tiktoken")


def test_sections_add_up(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    texts = [(r.doc_id, r.text) for r in docs.collect()] + [(-i, x) for i, x in EDGES] + [(900, "a\n\n\n b\r\n \n c")]
    want = {}
    for i, x in texts:
        x = x or ""
        chars = np.array([0] + [len(c.encode()) for c in x]).cumsum()
        starts = np.cumsum([0] + [len(line.encode()) for line in x.split("\n")]) + np.arange(len(x.split("\n")) + 1)
        n = Counter(int(np.searchsorted(starts[1:-1], chars[a], "right")) for a, _ in t.encode(x, add_special_tokens=False).offsets)
        want[i] = sum(n.values())
    df = spark.createDataFrame([(i, x, "c") for i, x in texts], "doc_id long, text string, section string")
    for rule in ("first", "most", "last"):
        got = Counter()
        for r in section_tokens(df, RANKS, P.PATTERN, rule).collect():
            got[r.doc_id] += r.n_tokens
            assert r.doc_tokens == want[r.doc_id]
        assert {i: got[i] for i in want} == want


@pytest.mark.parametrize("rule,size", [("first", 7), ("most", 7), ("last", 7), ("most", 100), ("most", 3)])
def test_every_section_against_brute_force(spark, sf, rule, size):
    """Byte ranges that cut through words: each token is followed byte by byte."""
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").limit(25).collect()] + [(-i, x) for i, x in EDGES]
    want, crossing = {}, 0
    for i, x in texts:
        x = x or ""
        n = len(x.encode())
        counts = [0] * max(1, -(-n // size))
        byte_of = np.cumsum([0] + [len(c.encode()) for c in x])
        at = 0
        for token in t.encode(x, add_special_tokens=False).tokens:
            mine = [(at + k) // size for k in range(len(token))]        # a byte-level token has a letter a byte
            at += len(token)
            to = {"first": mine[0], "last": mine[-1]}.get(rule, max(sorted(set(mine)), key=mine.count))
            counts[to] += 1
            crossing += len(set(mine)) > 1
        assert at == n == byte_of[-1]
        want.update({(i, k): c for k, c in enumerate(counts)})
    got = section_tokens(documents(spark, texts), RANKS, P.PATTERN, rule, byte_sections(size)).collect()
    assert {(r.doc_id, r.section): r.n_tokens for r in got} == want
    assert crossing > 100


def test_rules():
    tokens, sections = np.array([2, 5, 6, 12]), np.array([4, 6, 7, 10, 12])
    assert list(allocate(tokens, sections, "first")[0]) == [0, 0, 1, 2]
    assert list(allocate(tokens, sections, "last")[0]) == [0, 1, 1, 4]
    assert list(allocate(tokens, sections, "most")[0]) == [0, 0, 1, 3]
    assert list(allocate(tokens, sections, "most")[1]) == [False, True, False, True]
    assert list(line_sections(np.frombuffer(b"a\n\nb", np.uint8))) == [2, 3, 4]
    assert list(line_sections(np.frombuffer(b"a\n", np.uint8))) == [2] and list(line_sections(np.empty(0, np.uint8))) == [0]


def test_token_edges(spark):
    got = section_tokens(documents(spark, EDGES), RANKS, P.PATTERN).collect()
    assert {r.doc_id for r in got} == {i for i, _ in EDGES}
    assert [(r.start, r.end, r.n_tokens) for r in got if r.doc_id == 1] == [(0, 0, 0)]
    assert section_tokens(documents(spark, []), RANKS, P.PATTERN).count() == 0
    with pytest.raises(ValueError):
        section_tokens(documents(spark, []), RANKS, P.PATTERN, "none")


def stupid_backoff(rows, order, alpha, least):
    words = {i: re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for i, t in rows}
    c = Counter()
    for w in words.values():
        for n in range(1, order + 1):
            c.update(tuple(w[j:j + n]) for j in range(len(w) - n + 1))
    total = sum(map(len, words.values()))
    out = {}
    for i, w in words.items():
        s = 0.0
        for j in range(len(w)):
            n, pay = min(order, j + 1), 0.0
            while n > 1 and c[tuple(w[j - n + 1:j + 1])] < least:
                n, pay = n - 1, pay + math.log(alpha)
            top = c[tuple(w[j - n + 1:j + 1])]
            s += pay + math.log(top / (c[tuple(w[j - n + 1:j])] if n > 1 else total))
        out[i] = (len(w), s)
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_backoff(spark, order):
    rows = EDGES + [(60, "The cat sat on the mat"), (61, "the cat sat on a mat the cat"), (62, "the cat sat on the mat")]
    want = stupid_backoff(rows, order, 0.4, 2)
    got = {r.doc_id: r for r in lm_scores(documents(spark, rows), order=order).collect()}
    assert len(got) == len(rows)
    for i, (n, s) in want.items():
        assert got[i].n_words == n and abs(got[i].log_score - s) < 1e-6 * max(1, abs(s))
        assert got[i].mean_log_score is None if n == 0 else abs(got[i].mean_log_score - s / n) < 1e-6
    assert lm_scores(documents(spark, [])).count() == 0
