import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Regex, Tokenizer, normalizers

from timewise.llm import packing
from timewise.llm.packing import WordEncoder, differencing, pack, pack_cut, pack_whole, parted

from .helpers import EDGES, documents

PATH = P.path("word_bpe_49k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 300), max_size=40))
def test_cut_windows_are_full_and_complete(sizes):
    windows, left = pack_cut(sizes, 64)
    assert left == []
    full, left = pack_cut(sizes, 64, last=False)
    assert all(sum(p[2] for p in w) == 64 for w in full) and sum(p[2] for p in left) == sum(sizes) % 64
    assert sum(n for w in full for *_, n in w) + sum(n for *_, n in left) == sum(sizes)
    pieces = sorted(p for w in windows for p in w)
    assert [n for n in map(lambda w: sum(p[2] for p in w), windows) if n & (n - 1)] == []
    at = defaultdict(int)
    for i, s, n in pieces:
        assert n > 0 and s == at[i]
        at[i] += n
    assert [at[i] for i in range(len(sizes))] == sizes


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=40))
def test_whole_windows_keep_the_capacity(sizes):
    w = pack_whole(sizes, 64)
    if sizes:
        assert np.bincount(w, sizes).max() <= 64


def test_differencing_evens_out():
    # the classic example: differencing leaves a spread of 2 (16 and 14)
    w = differencing(np.array([8, 7, 6, 5, 4]), 2)
    assert sorted(np.bincount(w, [8, 7, 6, 5, 4])) == [14, 16]
    r = np.random.default_rng(0)
    sizes = r.integers(1, 1000, 3000)
    sums = np.bincount(differencing(sizes, 300), sizes)
    assert sums.max() - sums.min() < 0.05 * sums.mean()


def check(spark, rows, block, **kw):
    t = Tokenizer.from_file(PATH)
    ids = {i: np.array(t.encode(x or "", add_special_tokens=False).ids + [2], "<u4") for i, x in rows}
    out = pack(documents(spark, rows), PATH, block_tokens=block, **kw).collect()
    by, seq = defaultdict(list), defaultdict(list)
    for r in out:
        piece = ids[r.doc_id][r.start:r.start + r.length]
        assert (zlib.crc32(piece.tobytes()), len(ids[r.doc_id])) == (r.ids_crc32, r.doc_tokens)
        by[r.doc_id].append((r.start, r.length))
        seq[r.sequence_id].append((r.offset, r.length))
    for spans, full in [(by[i], len(ids[i])) for i in ids] + [(s, None) for s in seq.values()]:
        at = 0
        for a, n in sorted(spans):
            assert a == at
            at += n
        assert at == full if full is not None else at <= 4096
    return seq, out


def test_round_trip(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    seq, out = check(spark, rows, 50_000)
    # blocks of one task share their remainder: at most 12 windows a task are not full
    tasks = len({i >> 40 for i in seq})
    assert sum(sum(n for _, n in s) < 4096 for s in seq.values()) <= 12 * tasks
    seq, out = check(spark, rows, 50_000, cut=False)
    long = {r.doc_id for r in out if r.doc_tokens > 4096}
    assert all(r.length == r.doc_tokens for r in out if r.doc_id not in long)


def test_edges(spark):
    check(spark, EDGES + [(30, "<|endoftext|> a<|startoftext|>b İstanbul ΣΑΣ it's 12,5  x y\x85z \x1cq"), (31, "x " * 30000)], 600_000)
    assert pack(documents(spark, []), PATH).count() == 0


ODD = ["It's a NAÏVE café, isn't it? don't,stop", "straße,groß.Straße ÿ÷ÿ x́,é. É,é İx ΣΑΣ,σας", "a,b..c...d ,'s foo,'s foo's, foo', o'clock,", "12,5 a1,b2; x=y <b>bold</b> <<a|b>> **kw**",
       "Word <|endoftext|>, Word,word <|StartOfText|> tail", "x<| y|>,z", "a\x1cb c\x85d e f,g h", "日本,語。 \U0001f600,a ́,b é̸,= a̸", "", " ,", "</w> a</w>,b", "re,'re we're,they'll"]


def test_encoder_gives_the_tokenizers_ids():
    t, enc = Tokenizer.from_file(PATH), WordEncoder(PATH, 2)
    assert enc.plain is not None
    rng = np.random.default_rng(1)
    signs = list("aeéßüñzKÉ09 \t\n,.'!*<|>-_ś·…") + [" ", ", ", "the ", "'s "]
    texts = ODD + ["".join(rng.choice(signs, 60)) for _ in range(600)]
    raw = [x.encode() for x in texts]
    offs = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    got = enc.encode(parted(np.frombuffer(b"".join(raw), np.uint8), offs))
    for x, ids in zip(texts, got, strict=True):
        assert ids.tolist() == t.encode(x, add_special_tokens=False).ids + [2], x


def test_other_tokenizers_take_the_marked_way(tmp_path):
    t = Tokenizer.from_file(PATH)
    t.normalizer = normalizers.Sequence([normalizers.NFD(), normalizers.Replace(Regex(r"\s+"), " "), normalizers.Lowercase()])
    t.save(str(tmp_path / "t.json"))
    enc = WordEncoder(str(tmp_path / "t.json"))
    text = "één straße, café x"
    assert enc.plain is None and enc.encode([text.encode()])[0].tolist() == t.encode(text, add_special_tokens=False).ids


def test_words_are_learned_once(monkeypatch):
    """A word before punctuation is no new word, and a worker that has seen
    many rare words still knows the frequent ones."""
    monkeypatch.setattr(packing, "WORDS_KEPT", 300)
    t, enc = Tokenizer.from_file(PATH), WordEncoder(PATH)
    learned = []
    monkeypatch.setattr(enc, "learn", lambda learn=enc.learn: (learned.extend(enc.index.queue), learn())[1])
    for k in range(20):
        text = f"common Common, (common) straße. straße {' '.join(f'rare{chr(97 + k)}{chr(97 + i)}' for i in range(26))} twice{chr(97 + k)} twice{chr(97 + k)}!"
        raw = text.encode()
        [ids] = enc.encode(parted(np.frombuffer(raw, np.uint8), np.array([0, len(raw)])))
        assert ids.tolist() == t.encode(text, add_special_tokens=False).ids
        assert len(enc.index) < 400
    assert learned.count(b"common") == learned.count("straße".encode()) == 1
    assert not any(w.startswith(b"common,") for w in learned) and len(learned) > 500
