"""Exact-substring deduplication by a hash-compared suffix sort.

A byte is removed when a ``length``-byte string that covers it also starts
anywhere else, in another text or the same one; overlaps count, and matches
never cross texts.  Everything is judged on the input.

Why not all suffixes: sorting every suffix of a corpus moves many times its
size.  Two equal strings of ``length`` bytes have the same grams, so the least
gram hash among their ``length - GRAM + 1`` grams stands at the same offset in
both.  The suffixes at these anchors (about 1 % of all) are sorted; every
window of the corpus is served by exactly one anchor, so no repeat is missed.

1. Texts are named by SHA-256 (in the scan by 64 bits of it, under a salt that
   keeps all names apart).  Equal texts of at least ``length`` bytes are
   removed whole and searched through one representative.
2. One scan emits the anchors (gram hash, text, position, range of window
   starts it serves) as packed arrays, one row per (batch, hash part).
   Anchors with the same surroundings inside one text (periodic passages)
   mark their windows at once and go on as one.
3. Per hash part, only grams that occur twice keep their anchors.
4. Their surroundings (at most 2 * length bytes) are cut out of the texts and
   meet in hash parts.  There the suffixes at the anchors are mergesorted:
   prefix polynomial hashes and binary search give the common extension of
   two suffixes in logarithmic time, the byte after it decides.  A second
   sort runs on the reversed prefixes.  Neighbours in either order yield
   repeated windows; accepted matches are compared byte by byte.
   Windows that a neighbour could not settle, but the extensions allow, are
   settled by sorting the window hashes of the group, verified by bytes.
5. Groups above ``HOT`` anchors never meet in one task: their windows are
   hashed and counted by a grouped aggregation (combined map-side) and joined
   back, which decides the same question exactly.
6. Spans merge per text and the rest of the text is concatenated.

Edge cases: null text is empty; texts below ``length`` bytes are never
touched; a row without an id is left whole and counts as no repeat of others
(unless an equal text has an id); equal rows count as repeats of each other; an empty table gives an
empty result; extra columns are ignored.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_text, checkpointed, joined_few, n_partitions, small, tidy
from .textblock import blocks, lean, lean_group, mix, prefix_hash, span_hash

GRAM = 0.4       # share of the match length that makes a gram
HOT = 8192       # anchors of one gram that may meet in one task
PASSAGE = 220    # bytes; a passage of 51 words is longer in any of the languages, but often shorter than 400


def gram_size(length: int) -> int:
    return max(1, int(length * GRAM))


def anchors(data: np.ndarray, offs: np.ndarray, length: int):
    """(row, anchor, first served start, last served start, gram hash) of a
    block of texts, positions within the block.

    Every start s of a full window has as its anchor the leftmost least gram
    of the window; runs of starts with one anchor form one entry."""
    k = gram_size(length)
    n = len(data)
    none = np.empty(0, np.int64)
    if n < length:
        return none, none, none, none, np.empty(0, np.uint64)
    p = prefix_hash(data)
    at = np.arange(n - k + 1)
    gram = mix(span_hash(p, at, at + k))
    bits = np.uint64(max(20, int(n).bit_length()))
    m = (gram >> bits << bits) | at.astype(np.uint64)
    width, want = 1, length - k + 1
    while 2 * width <= want:
        m = np.minimum(m[:-width], m[width:])
        width *= 2
    if width < want:
        m = np.minimum(m[:len(m) - (want - width)], m[want - width:])
    # starts whose window stays inside one text
    row = np.searchsorted(offs, np.arange(n - length + 1), "right") - 1
    s = np.flatnonzero(np.arange(n - length + 1) + length <= offs[row + 1])
    if len(s) == 0:
        return none, none, none, none, np.empty(0, np.uint64)
    pos = (m[s] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (pos[1:] != pos[:-1]) | (row[s[1:]] != row[s[:-1]])]))
    last = np.concatenate([new[1:], [len(s)]]) - 1
    return row[s[new]], pos[new], s[new], s[last], gram[pos[new]]


def _scan(parts: int, length: int):
    """Anchors of the texts (columns: text, tid) in packed arrays.  Rows with
    own = 1 hold spans already known to repeat inside their text."""
    def run(batches):
        for batch in batches:
            tid = batch.column("tid").to_numpy(zero_copy_only=False)
            found, own = [], []
            for first, data, offs in blocks(batch.column("text")):
                row, pos, lo, hi, gram = anchors(data, offs, length)
                if len(row) == 0:
                    continue
                p = prefix_hash(data)
                around = mix(span_hash(p, lo, hi + length)) + mix((hi - lo).astype(np.uint64) * np.uint64(4096) + (pos - lo).astype(np.uint64))
                order = np.lexsort((lo, around, row))
                same = np.concatenate([[False], (row[order][1:] == row[order][:-1]) & (around[order][1:] == around[order][:-1])])
                # verify before marking: equal surroundings, byte by byte
                for i in np.flatnonzero(same):
                    a, b = order[i - 1], order[i]
                    if data[lo[a]:hi[a] + length].tobytes() != data[lo[b]:hi[b] + length].tobytes():
                        same[i] = False
                twin = same.copy()
                twin[:-1] |= same[1:]
                base = offs[row]
                t = tid[first + row]
                i = order[twin]
                own.append((t[i], lo[i] - base[i], hi[i] + length - base[i]))
                i = order[~same]
                found.append((gram[i], t[i], pos[i] - base[i], lo[i] - base[i], hi[i] - base[i]))
            out = []
            if found:
                g, t, pos, lo, hi = (np.concatenate(x) for x in zip(*found))
                part = (g % np.uint64(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                cut = np.searchsorted(part[order], np.arange(parts + 1))
                g, t, where = g[order], t[order], np.stack([pos, lo, hi], 1).astype(np.int32)[order]
                out += [(int(i), 0, g[cut[i]:cut[i + 1]].tobytes(), t[cut[i]:cut[i + 1]].tobytes(), where[cut[i]:cut[i + 1]].tobytes())
                        for i in np.flatnonzero(np.diff(cut))]
            if own and sum(len(x[0]) for x in own):
                t, a, b = (np.concatenate(x) for x in zip(*own))
                where = np.stack([a, b], 1).astype(np.int32)
                out.append((int(t[0] % parts), 1, b"", t.tobytes(), where.tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, y) for x, y in zip(zip(*out), (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))],
                                                 ["part", "own", "gram", "tid", "place"])
    return run


def _joined(column, dtype):
    return np.concatenate([np.frombuffer(x.as_py(), dtype) for x in column] or [np.empty(0, dtype)])


def _repeated(table: pa.Table) -> pa.Table:
    """Anchors of one hash part whose gram occurs at two places; their number
    per gram.  Rows with own = 1 pass through as (tid, lo, hi) spans."""
    import pyarrow.compute as pc
    mine = table.filter(pc.equal(table.column("own"), 1))
    rest = table.filter(pc.equal(table.column("own"), 0))
    st = _joined(mine.column("tid"), np.int64)
    sw = _joined(mine.column("place"), np.int32).reshape(-1, 2)
    g, t = _joined(rest.column("gram"), np.uint64), _joined(rest.column("tid"), np.int64)
    w = _joined(rest.column("place"), np.int32).reshape(-1, 3)
    order = np.argsort(g, kind="stable")
    g = g[order]
    same = np.zeros(len(g), bool)
    same[1:] |= g[1:] == g[:-1]
    same[:-1] |= g[1:] == g[:-1]
    g, order = g[same], order[same]
    t, w = t[order], w[order]
    order = np.lexsort((w[:, 0], t, g))      # equal texts emit equal anchors
    g, t, w = g[order], t[order], w[order]
    if len(g):
        new = np.concatenate([[True], (g[1:] != g[:-1]) | (t[1:] != t[:-1]) | (w[1:, 0] != w[:-1, 0])])
        g, t, w = g[new], t[new], w[new]
        first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
        n = np.diff(np.concatenate([first, [len(g)]]))
        n = np.repeat(n, n)
        g, t, w, n = g[n > 1], t[n > 1], w[n > 1], n[n > 1]
    else:
        n = np.empty(0, np.int64)
    zero = np.zeros(len(st), np.int64)
    return pa.table({"own": pa.array(np.concatenate([np.ones(len(st), np.int32), np.zeros(len(g), np.int32)])),
                     "gram": np.concatenate([zero, g.view(np.int64)]), "n": np.concatenate([zero, n]),
                     "tid": np.concatenate([st, t]),
                     "pos": np.concatenate([zero.astype(np.int32), w[:, 0]]), "lo": np.concatenate([sw[:, 0], w[:, 1]]),
                     "hi": np.concatenate([sw[:, 1], w[:, 2]])})


def _around(length: int):
    """Cut the surroundings of the marked anchors out of their texts."""
    def run(batches):
        for batch in batches:
            for text, doc, marks in zip(batch.column("text"), batch.column("doc_id").to_pylist(), batch.column("marks")):
                data = text.as_py().encode()
                m = marks.values
                lo, hi = m.field("lo").to_numpy(), m.field("hi").to_numpy()
                yield pa.RecordBatch.from_arrays([
                    m.field("part"), m.field("gram"), pa.array(np.full(len(m), doc, np.int64)), m.field("pos"), m.field("lo"), m.field("hi"),
                    pa.array([data[a:b + length] for a, b in zip(lo, hi)], pa.binary())],
                    ["part", "gram", "doc_id", "pos", "lo", "hi", "around"])

    def packed(batches):
        held, rows = [], 0
        for b in run(batches):
            held.append(b)
            rows += b.num_rows
            if rows >= 5000:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, rows = [], 0
        if held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    return packed


class Suffixes:
    """Suffixes (or reversed prefixes) at given places of one byte array,
    compared through prefix hashes."""

    def __init__(self, data: np.ndarray, at: np.ndarray, left: np.ndarray, right: np.ndarray):
        self.data, self.at, self.left, self.right = data, at, left, right
        self.p = prefix_hash(data)

    def common(self, i: np.ndarray, j: np.ndarray, back: bool) -> np.ndarray:
        """Length of the common extension of places i and j, by binary search
        over the prefix hashes."""
        room = self.left if back else self.right
        lo = np.zeros(len(i), np.int64)
        hi = np.minimum(room[i], room[j])
        a, b = self.at[i], self.at[j]
        for _ in range(int(hi.max(initial=0)).bit_length()):
            mid = (lo + hi + 1) >> 1
            if back:
                eq = span_hash(self.p, a - mid, a) == span_hash(self.p, b - mid, b)
            else:
                eq = span_hash(self.p, a, a + mid) == span_hash(self.p, b, b + mid)
            lo, hi = np.where(eq, mid, lo), np.where(eq, hi, np.maximum(mid - 1, lo))
        return lo

    def before(self, i: np.ndarray, j: np.ndarray, back: bool) -> np.ndarray:
        """Whether suffix i sorts strictly before suffix j."""
        room = self.left if back else self.right
        n = self.common(i, j, back)
        ends_i, ends_j = n >= room[i], n >= room[j]
        top = len(self.data) - 1
        if back:
            ci, cj = self.data[np.maximum(self.at[i] - n - 1, 0)], self.data[np.maximum(self.at[j] - n - 1, 0)]
        else:
            ci, cj = self.data[np.minimum(self.at[i] + n, top)], self.data[np.minimum(self.at[j] + n, top)]
        return np.where(ends_i | ends_j, ends_i & ~ends_j, ci < cj)

    def mergesort(self, first: np.ndarray, size: np.ndarray, back: bool) -> np.ndarray:
        """Order of the places, sorted within each group (groups are runs of
        ``size`` places from ``first``).  All groups merge at once, bottom up;
        an element finds its place in the sibling run by binary search."""
        n = len(self.at)
        order = np.arange(n)
        g_first, g_end = np.repeat(first, size), np.repeat(first + size, size)
        local = np.arange(n) - g_first
        width = 1
        while width < int(size.max(initial=1)):
            run = local // width
            start = g_first + (run ^ 1) * width           # sibling run
            stop = np.minimum(start + width, g_end)
            mine = np.flatnonzero(start < g_end)
            lo, hi = start[mine].copy(), stop[mine].copy()
            right = (run[mine] & 1) == 1                   # ties: left run first
            while True:
                todo = np.flatnonzero(lo < hi)
                if len(todo) == 0:
                    break
                mid = (lo[todo] + hi[todo]) >> 1
                other, own = order[mid], order[mine[todo]]
                # advance past "other" if it sorts before "own" (left element:
                # strictly; right element: before or equal)
                go = np.where(right[todo], ~self.before(own, other, back), self.before(other, own, back))
                lo[todo], hi[todo] = np.where(go, mid + 1, lo[todo]), np.where(go, hi[todo], mid)
            new = np.arange(n)
            rank = lo - start[mine]
            base = g_first[mine] + (run[mine] & ~1) * width
            new[mine] = base + (local[mine] - run[mine] * width) + rank
            out = np.empty(n, np.int64)
            out[new] = order
            order = out
            width *= 2
        return order


def resolve_spans(length: int):
    """Covered spans of the anchors of one hash part."""
    radix = length + 1

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        gram = table.column("gram").to_numpy()
        order = np.argsort(gram, kind="stable")
        table = table.take(pa.array(order))
        gram, doc, pos, lo, hi = (table.column(c).to_numpy() for c in ("gram", "doc_id", "pos", "lo", "hi"))
        pos, lo, hi = pos.astype(np.int64), lo.astype(np.int64), hi.astype(np.int64)
        raw = b"".join(x.as_py() for x in table.column("around"))
        data = np.frombuffer(raw, np.uint8)
        size_of = hi - lo + length
        off = np.concatenate([[0], np.cumsum(size_of)])[:-1]
        at, left = off + pos - lo, pos - lo
        sfx = Suffixes(data, at, left, size_of - left)
        first = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
        size = np.diff(np.concatenate([first, [len(gram)]]))
        group = np.repeat(np.arange(len(first)), size)
        a_lo, a_hi = pos - hi, pos - lo                    # served offsets of the anchor in its window
        starts, ends = [], []                              # covered (member, first offset, last offset)
        most = {False: np.zeros(len(gram), np.int64), True: np.zeros(len(gram), np.int64)}
        resolved = np.zeros((len(gram), 4, 2), np.int64)
        resolved[:, :, 0], resolved[:, :, 1] = 1, 0        # empty intervals
        bad = np.zeros(len(first), bool)                   # a hash collision was seen
        for turn, back in enumerate((False, True)):
            o = sfx.mergesort(first, size, back)
            nxt = np.flatnonzero(group[o[1:]] == group[o[:-1]])
            i, j = o[nxt], o[nxt + 1]
            r, l_ = sfx.common(i, j, False), sfx.common(i, j, True)
            ext = l_ if back else r
            np.maximum.at(most[back], i, ext)
            np.maximum.at(most[back], j, ext)
            hit = np.flatnonzero(l_ + r >= length)
            for x in hit:                                  # collision verification, byte by byte
                p, q, u, v = at[i[x]], at[j[x]], l_[x], r[x]
                if raw[p - u:p + v] != raw[q - u:q + v]:
                    bad[group[i[x]]] = True
            for side, who in enumerate((i, j)):
                w = who[hit]
                x, y = np.maximum(length - r[hit], a_lo[w]), np.minimum(l_[hit], a_hi[w])
                resolved[w, 2 * turn + side, 0], resolved[w, 2 * turn + side, 1] = x, y
        ok = ~bad[group]
        for c in range(4):
            x, y = resolved[:, c, 0], resolved[:, c, 1]
            m = np.flatnonzero(ok & (x <= y))
            starts.append((m, x[m], y[m]))
        # offsets that the extensions allow but no neighbour settled
        can_lo = np.maximum(a_lo, length - most[False])
        can_hi = np.minimum(a_hi, most[True])
        can_lo[~ok], can_hi[~ok] = a_lo[~ok], a_hi[~ok]
        big = (size[group] > 2) | ~ok
        reach_lo, reach_hi = can_lo.copy(), can_hi.copy()
        by_lo = np.sort(np.where((resolved[:, :, 0] <= resolved[:, :, 1]) & ok[:, None], resolved[:, :, 0] * radix + resolved[:, :, 1], -1), axis=1)
        for c in range(4):                                 # peel settled offsets off both ends
            x, y = by_lo[:, c] // radix, by_lo[:, c] % radix
            m = (by_lo[:, c] >= 0) & (x <= reach_lo) & (y >= reach_lo)
            reach_lo[m] = y[m] + 1
        for c in (3, 2, 1, 0):
            x, y = by_lo[:, c] // radix, by_lo[:, c] % radix
            m = (by_lo[:, c] >= 0) & (x <= reach_hi) & (y >= reach_hi)
            reach_hi[m] = x[m] - 1
        left_over = np.flatnonzero(big & (reach_lo <= reach_hi))
        if len(left_over):
            g_lo = np.full(len(first), 1 << 40)
            g_hi = np.full(len(first), -1)
            np.minimum.at(g_lo, group[left_over], reach_lo[left_over])
            np.maximum.at(g_hi, group[left_over], reach_hi[left_over])
            w_lo, w_hi = np.maximum(a_lo, g_lo[group]), np.minimum(a_hi, g_hi[group])
            member = np.flatnonzero(w_lo <= w_hi)
            # whole groups at a time, about two million windows at once
            load = np.cumsum(w_hi[member] - w_lo[member] + 1)
            slot = load // 2_000_000
            begin = 0
            while begin < len(member):
                end = int(np.searchsorted(slot, slot[begin], "right"))
                while end < len(member) and group[member[end]] == group[member[end - 1]]:
                    end += 1
                starts.append(_by_windows(sfx, raw, member[begin:end], group, w_lo, w_hi, length))
                begin = end
        m, x, y = (np.concatenate(z) for z in zip(*starts))
        return pa.table({"doc_id": doc[m], "start": pos[m] - y, "end": pos[m] - x + length})
    return run


def _by_windows(sfx: Suffixes, raw: bytes, member, group, w_lo, w_hi, length: int):
    """Single offsets (member, offset, offset) whose window repeats in the
    group, from sorted window hashes."""
    n = w_hi[member] - w_lo[member] + 1
    who = np.repeat(member, n)
    a = np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n) + w_lo[who]
    start = sfx.at[who] - a
    h = span_hash(sfx.p, start, start + length)
    order = np.lexsort((h, a, group[who]))
    who, a, h, start = who[order], a[order], h[order], start[order]
    eq = (group[who[1:]] == group[who[:-1]]) & (a[1:] == a[:-1]) & (h[1:] == h[:-1])
    keep = np.zeros(len(who), bool)
    for x in np.flatnonzero(eq):
        # runs of equal hashes are compared with their predecessor; on a
        # collision the run is settled by its bytes
        if raw[start[x]:start[x] + length] == raw[start[x + 1]:start[x + 1] + length]:
            keep[x] = keep[x + 1] = True
        else:
            b = x
            while b > 0 and eq[b - 1]:
                b -= 1
            e = x + 1
            while e < len(eq) and eq[e]:
                e += 1
            seen: dict[bytes, int] = {}
            for y in range(b, e + 1):
                s = raw[start[y]:start[y] + length]
                if s in seen:
                    keep[y] = keep[seen[s]] = True
                seen.setdefault(s, y)
    return who[keep], a[keep], a[keep]


def _windows(length: int):
    """Hot grams: every served window as (doc_id, start, two hashes)."""
    def run(batches):
        for batch in batches:
            for doc, lo, hi, around in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "lo", "hi", "around"))):
                data = np.frombuffer(around, np.uint8)
                s = np.arange(hi - lo + 1)
                h1 = span_hash(prefix_hash(data), s, s + length)
                h2 = span_hash(prefix_hash(data[::-1] ^ np.uint8(0x5A)), len(data) - s - length, len(data) - s)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), doc)), pa.array(s + lo), pa.array(mix(h1).view(np.int64)),
                                                  pa.array(mix(h2).view(np.int64))], ["doc_id", "start", "h1", "h2"])
    return run


def _merge(batches):
    """Overlapping or touching spans of a text become one."""
    for batch in batches:
        out = []
        for spans in batch.column("spans"):
            s, e = spans.values.field("start").to_numpy(), spans.values.field("end").to_numpy()
            order = np.argsort(s, kind="stable")
            s, e = s[order], np.maximum.accumulate(e[order])
            new = np.concatenate([[True], s[1:] > e[:-1]])
            first = np.flatnonzero(new)
            out.append([{"start": int(a), "end": int(b)} for a, b in zip(s[first], e[np.concatenate([first[1:], [len(s)]]) - 1])])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                                         ["doc_id", "spans"])


_SPANS = "array<struct<start:bigint,end:bigint>>"


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, hot: int = HOT) -> DataFrame:
    """(doc_id, spans) of every document with a repeat: maximal byte ranges
    [start, end) covered by a ``length``-byte string that occurs elsewhere.
    ``hot`` only chooses between two exact ways."""
    spark = docs.sparkSession
    texts = as_text(docs, id_col, text_col)
    named = texts.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha"))
    classes = checkpointed(named.where(F.col("n_bytes") >= length).groupBy("sha", "n_bytes")
                           .agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")).where("rep is not null"))
    # short names of the digests: the first salt under which all differ
    salt = 0
    while classes.groupBy(F.xxhash64("sha", F.lit(salt)).alias("tid")).count().where("count > 1").take(1):
        salt += 1
    classes = classes.withColumn("tid", F.xxhash64("sha", F.lit(salt)))
    parts = 4 * n_partitions(spark)
    marks = checkpointed(texts.where((F.octet_length("text") >= length) & F.col("doc_id").isNotNull())
                         .select("text", F.xxhash64(F.sha2("text", 256), F.lit(salt)).alias("tid"))
                         .mapInArrow(lean(_scan(parts, length)), "part int, own int, gram binary, tid binary, place binary")
                         .groupBy("part").applyInArrow(lean_group(_repeated), "own int, gram long, n long, tid long, pos int, lo int, hi int"))
    tidy(spark)
    marks = checkpointed(marks.join(classes.select("tid", F.col("rep").alias("doc_id")), "tid").drop("tid"))
    own = marks.where("own = 1").select("doc_id", F.col("lo").cast("long").alias("start"), F.col("hi").cast("long").alias("end"))

    def surroundings(which):
        mine = marks.where("own = 0").where(which)
        per_doc = mine.groupBy("doc_id").agg(F.collect_list(F.struct(F.pmod(F.xxhash64("gram"), F.lit(parts)).cast("int").alias("part"),
                                                                     "gram", "pos", "lo", "hi")).alias("marks"))
        bearers = texts.join(small(mine.select("doc_id").distinct()), "doc_id", "left_semi")
        return bearers.dropDuplicates(["doc_id"]).join(per_doc, "doc_id").mapInArrow(
            lean(_around(length)), "part int, gram long, doc_id long, pos int, lo int, hi int, around binary")

    found = (surroundings(F.col("n") <= hot).groupBy("part")
             .applyInArrow(lean_group(resolve_spans(length)), "doc_id long, start long, end long").unionByName(own))
    if marks.where((F.col("own") == 0) & (F.col("n") > hot)).take(1):
        w = checkpointed(surroundings(F.col("n") > hot).mapInArrow(lean(_windows(length)), "doc_id long, start long, h1 long, h2 long"))
        often = w.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2")
        found = found.unionByName(w.join(often, ["h1", "h2"]).select("doc_id", "start", (F.col("start") + length).alias("end")))
    spans = (found.groupBy("doc_id").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
             .mapInArrow(lean(_merge), f"doc_id long, spans {_SPANS}"))
    # one row per id, also where a row is given twice
    twice = small(classes.where("copies > 1").select("sha", "rep"))
    copies = (named.join(twice, "sha").select("doc_id", "n_bytes").distinct()
              .select("doc_id", F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end"))).alias("spans")))
    single = spans.join(twice.select(F.col("rep").alias("doc_id")), "doc_id", "left_anti")
    out = checkpointed(single.unionByName(copies))
    tidy(spark)
    return out


def covered(spans):
    """The number of bytes in the spans."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def kept_bytes(body, spans):
    """The bytes of ``body`` outside the spans: the ranges from the end of one
    to the start of the next."""
    ends, starts = F.transform(spans, lambda s: s["end"]), F.transform(spans, lambda s: s["start"])
    gaps = F.zip_with(F.concat(F.array(F.lit(0).cast("long")), ends), F.concat(starts, F.array(F.octet_length(body).cast("long"))),
                      lambda a, b: F.struct(a.alias("a"), (b - a).alias("n")))
    return F.aggregate(gaps, F.expr("cast('' as binary)"), lambda acc, g: F.concat(acc, F.substring(body, (g["a"] + 1).cast("int"), g["n"].cast("int"))))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, hot: int = HOT,
                   passage: int | None = None) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) for every document: the removed ranges
    and the remaining bytes, concatenated.  With ``passage``, ``n_repeated``
    counts the bytes covered by a repeated string of that many bytes; they
    stay, unless ``length`` bytes repeat."""
    body = as_text(docs, id_col, text_col).select("doc_id", F.col("text").cast("binary").alias("body"))
    spans = repeated_spans(docs, id_col, text_col, length, hot)
    rest = {"spans": F.expr(f"cast(array() as {_SPANS})")}
    if passage is not None:
        shorter = repeated_spans(docs, id_col, text_col, passage, hot).select("doc_id", covered("spans").alias("n_repeated"))
        rest["n_repeated"] = F.lit(0).cast("long")
        spans = (spans.join(shorter.groupBy("doc_id").agg(F.max("n_repeated").alias("n_repeated")), "doc_id", "full")
                 .select("doc_id", *[F.coalesce(c, v).alias(c) for c, v in rest.items()]))
    t = joined_few(body, spans, "doc_id", rest)
    return t.select("doc_id", F.octet_length("body").cast("long").alias("n_bytes"), *rest,
                    F.when(F.size("spans") == 0, F.col("body")).otherwise(kept_bytes(F.col("body"), F.col("spans"))).alias("kept"))
