"""Packing token sequences by Karmarkar-Karp multiway differencing.

Documents are tokenized and packed in blocks of consecutive rows of one scan
task, so packing shuffles nothing and a lost task is simply run again.

Differencing.  Each item starts as a partial partition (its size in one
window, nothing in the others).  The two partial partitions with the largest
spread are merged so that the fullest window of one meets the emptiest of the
other; the spreads cancel and near-equal windows remain.  With ``cut=False``
the window count starts at ceil(total / capacity) and rises until no window
exceeds the capacity.

With ``cut=True`` (free cutting) documents longer than the capacity first give
off full windows.  The total of the block modulo the capacity is cut off and
goes on to the task's next block; behind its last block it becomes windows of
power-of-two sizes, which need no padding.  The remaining total is a multiple
of the capacity, differencing brings every window near it, and the
overhang of a window is cut and moved to windows with room.  Every window is
then exactly full: there is no padding at all, and few documents are cut.

Edge cases: null text is empty text, whose one id is the end mark; an empty
table gives an empty result; repeated rows are packed as often as they occur;
extra columns are ignored; a very long text is encoded word by word and only
fills more windows.
"""
from __future__ import annotations

import heapq
import json
import os
import re
import sys
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import as_text
from .textblock import LOWER, blocks, lean

WORDS_KEPT = 300_000     # words (about 250 bytes each) remembered by one worker before it forgets the rare ones


#: The normalizer and the split pattern under which a plain word is one piece.
KNOWN = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}


class Index(dict):
    """Numbers words in order of first sight and queues the new ones."""

    def __init__(self):
        self.queue: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = i = len(self)
        self.queue.append(word)
        return i


#: Lower-case letters of ASCII and Latin-1, which no normalizer changes.
PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")

#: ASCII punctuation but the apostrophe, which contractions begin with.
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[[c for c in range(33, 127) if not chr(c).isalnum() and c != 39]] = True


def parted(data: np.ndarray, offs: np.ndarray) -> list[bytes]:
    """The texts of a block, lower-cased, with a space between a plain letter
    and punctuation behind it, so that a word and the same word before a comma
    are one.  Texts that could hold a special token, told by its case, stay."""
    low = LOWER[data]
    letter = (low >= 97) & (low <= 122)
    letter[1:] |= (low[:-1] == 0xC3) & (low[1:] >= 0x9F) & (low[1:] != 0xB7)
    at = np.flatnonzero(letter[:-1] & PUNCTUATION[low[1:]]) + 1
    special = np.flatnonzero((data[:-1] == 60) & (data[1:] == 124))
    for r in np.unique(np.searchsorted(offs, special, "right") - 1):
        low[offs[r]:offs[r + 1]] = data[offs[r]:offs[r + 1]]
        at = at[(at < offs[r]) | (at >= offs[r + 1])]
    raw, ends = np.insert(low, at, 32).tobytes(), offs + np.searchsorted(at, offs)
    return [raw[a:b] for a, b in zip(ends[:-1], ends[1:])]


class WordEncoder:
    """Token ids of texts under a tokenizer that lower-cases, drops white
    space and never joins words or letters with punctuation: a text's ids are
    its words' ids in order, so each word is encoded once per worker and
    looked up afterwards.  New words are encoded together.  Plain ones need
    neither normalizer nor split pattern where the file's are known to leave
    them whole; their last ids tell them apart.  Others have a special token
    in between."""

    def __init__(self, path: str, end_id: int | None = None, mark: str = "<|startoftext|>"):
        # a task has one core: the tokenizer's threads would only compete with the other tasks, and keep memory each
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.end, self.mark, self.mark_id = end_id, mark, self.tokenizer.token_to_id(mark)
        self.plain = None
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        suffix = file["model"].get("end_of_word_suffix")
        if suffix and all(file.get(k) == v for k, v in KNOWN.items()):
            self.plain = Tokenizer.from_file(path)
            self.plain.normalizer = normalizers.Sequence([])
            self.plain.pre_tokenizer = pre_tokenizers.Sequence(
                [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            vocab = self.plain.get_vocab()
            self.ends_word = np.zeros(max(vocab.values()) + 1, bool)
            self.ends_word[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        self.clear()

    def clear(self):
        self.index = Index()
        self.flat, self.used = np.empty(1 << 16, np.uint32), 0
        self.first, self.count = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.uses = np.zeros(1 << 16, np.int64)

    def forget(self):
        """Start anew with the words that came up twice or more since the last
        time, the most used ones if those are many."""
        uses = self.uses[:len(self.index)]
        keep = uses >= max(2, np.sort(uses)[-(WORDS_KEPT // 3):][0] + 1)
        old = np.flatnonzero(keep)
        words, n = [w for w, k in zip(self.index, keep) if k], self.count[old]
        end = np.cumsum(n)
        ids = self.flat[np.arange(n.sum()) + np.repeat(self.first[old] - end + n, n)]
        self.clear()
        self.index.update(zip(words, range(len(words))))
        self._room()
        self._store(np.arange(len(words)), n, ids)

    def _room(self):
        """Places for all numbers given so far."""
        if len(self.index) > len(self.first):
            grow = 2 * len(self.index) - len(self.first)
            self.first, self.count, self.uses = (np.concatenate([x, np.zeros(grow, np.int64)]) for x in (self.first, self.count, self.uses))

    def _store(self, numbers: np.ndarray, counts: np.ndarray, ids: np.ndarray):
        """The ids of several words, one after the other."""
        n = len(ids)
        if self.used + n > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty(len(self.flat) + n, np.uint32)])
        self.flat[self.used:self.used + n] = ids
        self.first[numbers], self.count[numbers] = self.used + np.cumsum(counts) - counts, counts
        self.used += n

    def _encode(self, tokenizer, groups: list[tuple[np.ndarray, str]], ends):
        """Encode and store groups of words; ``ends`` gives the ids that count
        and the end of each word among them.  An encoding is many times its
        ids, so few live at a time."""
        for i in range(0, len(groups), 8):
            few = groups[i:i + 8]
            for (numbers, _), e in zip(few, tokenizer.encode_batch_fast([t for _, t in few], add_special_tokens=False)):
                ids, end = ends(np.array(e.ids, np.uint32))
                self._store(numbers, np.diff(end, prepend=0), ids)

    def learn(self):
        """Encode the queued words: most of them many at a time; words that
        could be read as a special token alone."""
        words, self.index.queue = self.index.queue, []
        base = len(self.index) - len(words)         # the queue holds the latest numbers, in order
        self._room()
        easy, others, odd, plain = [], [], [], PLAIN.fullmatch if self.plain else lambda w: None
        for i, w in enumerate(words):
            (easy if plain(w) else odd if self.mark_id is None or b"<|" in w else others).append(i)

        def groups(which, between, size):
            for g in (which[i:i + size] for i in range(0, len(which), size)):
                yield np.array(g) + base, between.join([words[i] for i in g]).decode()

        def marked(ids):
            cut = np.append(np.flatnonzero(ids == self.mark_id), len(ids))
            return ids[ids != self.mark_id], cut - np.arange(len(cut))

        self._encode(self.plain, list(groups(easy, b" ", 512)), lambda ids: (ids, np.flatnonzero(self.ends_word[ids]) + 1))
        self._encode(self.tokenizer, list(groups(others, self.mark.encode(), 512)), marked)
        self._encode(self.tokenizer, list(groups(odd, b"", 1)), lambda ids: (ids, np.array([len(ids)])))

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text as ``parted`` gives it."""
        if len(self.index) > WORDS_KEPT:
            self.forget()
        get, numbers = self.index.__getitem__, []
        for t in texts:
            words = t.split()                       # white space here is space and 0x09-0x0D
            numbers.append(np.fromiter(map(get, words), np.int64, len(words)))
        if self.index.queue:
            self.learn()
        out = []
        if numbers:
            used = np.bincount(np.concatenate(numbers))
            self.uses[:len(used)] += used
        for k in numbers:
            a, n = self.first[k], self.count[k]
            end = np.cumsum(n)
            total = int(end[-1]) if len(end) else 0
            ids = np.empty(total + (self.end is not None), np.uint32)
            if total:
                ids[:total] = self.flat[np.arange(total) + np.repeat(a - end + n, n)]
            if self.end is not None:
                ids[total] = self.end
            out.append(ids)
        return out


def encoder(path: str, end_id: int | None = None) -> WordEncoder:
    """The worker's encoder; it outlives a task, so words stay known."""
    kept = sys.__dict__.setdefault("_timewise_encoders", {})
    if (path, end_id) not in kept:
        kept[path, end_id] = WordEncoder(path, end_id)
    return kept[path, end_id]


def differencing(sizes: np.ndarray, windows: int) -> np.ndarray:
    """The window (0..windows-1) of each item, by multiway differencing."""
    n = len(sizes)
    if windows <= 1 or n == 0:
        return np.zeros(n, np.int64)
    # a partial partition is the windows' sums in descending order
    heap, parts, merges = [], {}, []
    for i, s in enumerate(np.asarray(sizes, np.int64)):
        v = np.zeros(windows, np.int64)
        v[0] = s
        parts[i] = v
        heap.append((-int(s), i))
    heapq.heapify(heap)
    node = n
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        both = parts.pop(a) + parts.pop(b)[::-1]
        order = np.argsort(-both, kind="stable")
        both = both[order]
        parts[node] = both
        merges.append((a, b, order))
        heapq.heappush(heap, (-int(both[0] - both[-1]), node))
        node += 1
    # hand the final windows down the merge tree
    place = {node - 1: np.arange(windows)}
    out = np.zeros(n, np.int64)
    for up in range(len(merges) - 1, -1, -1):
        a, b, order = merges[up]
        mine = place.pop(n + up)
        at = np.empty(windows, np.int64)
        at[order] = mine
        for child, p in ((a, at), (b, at[::-1])):
            if child < n:
                out[child] = p[0]
            else:
                place[child] = p
    return out


def pack_whole(sizes, capacity: int) -> np.ndarray:
    """Windows for uncut items (each at most ``capacity``)."""
    sizes = np.asarray(sizes, np.int64)
    windows = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        w = differencing(sizes, windows)
        if len(sizes) == 0 or np.bincount(w, sizes).max() <= capacity:
            return w
        windows += 1


def pack_cut(sizes, capacity: int, last: bool = True) -> tuple[list[list[tuple[int, int, int]]], list[tuple[int, int, int]]]:
    """(windows, left over): windows are lists of pieces (item, start,
    length) that hold exactly ``capacity``.  What is left over is less than
    that; with ``last`` it too is cut into windows, of powers of two."""
    out = []
    rest = []                       # (item, start, length)
    for i, n in enumerate(map(int, sizes)):
        full = n // capacity
        out += [[(i, j * capacity, capacity)] for j in range(full)]
        if n > full * capacity:
            rest.append((i, full * capacity, n - full * capacity))

    def taken(need):
        window = []
        while need:
            i, s, n = rest.pop()
            take = min(n, need)
            window.append((i, s + n - take, take))
            if n > take:
                rest.append((i, s, n - take))
            need -= take
        return window

    extra, left = sum(x[2] for x in rest) % capacity, []
    if last:
        out += [taken(1 << k) for k in range(extra.bit_length()) if extra >> k & 1]
    else:
        left = taken(extra)
    if not rest:
        return out, left
    windows = sum(x[2] for x in rest) // capacity
    where = differencing(np.array([x[2] for x in rest]), windows)
    bins: list[list] = [[] for _ in range(windows)]
    for w, piece in zip(where, rest):
        bins[w].append(piece)
    loose, room = [], []
    for b in bins:
        over = sum(x[2] for x in b) - capacity
        while over > 0:             # cut the overhang off the last piece
            i, s, n = b.pop()
            take = min(n, over)
            loose.append((i, s + n - take, take))
            if n > take:
                b.append((i, s, n - take))
            over -= take
        if over < 0:
            room.append([b, -over])
    for i, s, n in loose:
        while n:
            b, free = room[-1]
            take = min(n, free)
            b.append((i, s, take))
            s, n = s + take, n - take
            if take == free:
                room.pop()
            else:
                room[-1][1] -= take
    return out + bins, left


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, vocabulary: str, end_id: int = 2, capacity: int = 4096, id_col: str = "doc_id",
         text_col: str = "text", block_tokens: int = 600_000, cut: bool = True) -> DataFrame:
    """One row per piece: (doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset).  ``vocabulary`` is the path of a tokenizer file that
    drops white space between words; a document's ids end with ``end_id``.
    A block closes at ``block_tokens`` ids (a longer document is a block).
    Without ``cut`` only documents longer than the capacity are cut, and the
    window count of a block rises until nothing exceeds the capacity."""
    def run(batches):
        from pyspark import TaskContext
        enc = encoder(vocabulary, end_id)
        serial = TaskContext.get().partitionId() << 40
        held: list = []             # (document, its ids, first id of the part, length of the part)

        def windows(last):
            sizes = [n for *_, n in held]
            if cut:
                return pack_cut(sizes, capacity, last)
            out = [[(i, j * capacity, capacity)] for i, n in enumerate(sizes) for j in range(n // capacity)]
            rest = [(i, n // capacity * capacity, n % capacity) for i, n in enumerate(sizes) if n % capacity]
            bins: dict[int, list] = {}
            for w, piece in zip(pack_whole([p[2] for p in rest], capacity), rest):
                bins.setdefault(int(w), []).append(piece)
            return out + list(bins.values()), []

        def flush(last):
            nonlocal serial, held
            full, left = windows(last)
            cols = [[] for _ in range(7)]
            for window in full:
                at = 0
                for i, start, n in window:
                    doc, ids, first, _ = held[i]
                    start += first
                    crc = zlib.crc32(ids[start:start + n].astype("<u4").tobytes())
                    for c, v in zip(cols, (doc, start, n, crc, len(ids), serial, at)):
                        c.append(v)
                    at += n
                serial += 1
            held = [(held[i][0], held[i][1], held[i][2] + s, n) for i, s, n in left]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                              ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        size = 0
        for batch in batches:
            keys = batch.column("doc_id").to_pylist()
            for first, data, offs in blocks(batch.column("text"), 1 << 21):
                texts = parted(data, offs)
                for key, x in zip(keys[first:first + len(texts)], enc.encode(texts)):
                    held.append((key, x, 0, len(x)))
                    size += len(x)
                    if size >= block_tokens:
                        yield flush(False)
                        size = sum(n for *_, n in held)
        if held:
            yield flush(True)

    return as_text(docs, id_col, text_col).mapInArrow(lean(run), PIECES)
