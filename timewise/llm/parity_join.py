"""Near-duplicate join on word shingles by parity sketches.

Two documents link when 100 * |A & B| >= threshold * |A | B| over their sets
of distinct 5-word shingles.  For linked sets of sizes a <= b the symmetric
difference is at most D = floor((100 - t) * (a + b) / (100 + t)).

Sketch.  The shingles of a set are dealt over G chunks by hash.  In its chunk
a shingle flips one bit of a very wide parity sketch; the XOR of the mixed
shingle hashes names the chunk's odd bits in 64 bits.  A shingle in the
symmetric difference changes one bit, so the Hamming distance of two
sketches, and also the number of differing chunks, is at most |A ^ B|.

Pigeonhole.  G is fixed per size band (ratio 2), so linked sets differ in at
most D chunks.  Chunks holding at least ``weight`` shingles (2; 1 in small
bands) are strong.  If either set has more than D strong chunks, one strong
chunk is equal in both, and an equi-join on (band, salt, chunk, parity) finds
the pair.  A set with too few strong chunks is dealt again under the next
salt until it has enough; a pair meets at the first salt where one of the two
has enough, because both emit up to their own last salt.  A set that never
gets there emits its shingles one by one.  So no link is lost and nothing
is capped.  A set is emitted in its own band and, where a larger partner could
lie in the next band, in that one too.

Skew.  Equal sets collapse into one class first (a grouped minimum, combined
map-side), so a group of exact copies is one member.  Chunk keys travel as
packed arrays, one row per (task batch, hash part).  In a bucket only pairs
with its least member are made (a star).  They are filtered by size and by
the Hamming distance of a dense 1024-bit sketch, then verified on the whole
sets.  After a first components pass, only buckets that still hold members of
different components matter; members of one component need no more pairs.
Small ones contribute their remaining cross pairs, through an equi-join.
A crowded one comes from a large group of near copies or a passage that many
texts share.  It first gets a second star, on its most central member, which
joins near copies.  What is left is compared in the crowded bucket only where
it could be missed elsewhere.  A pair is sure to meet at the lesser of the two
last salts, because both emit there and the set whose last salt it is has more
strong chunks than the two can differ in (sets that fell back to shingles
count as one salt further on).  That still holds when the set ignores its
crowded buckets, as long as it spent no more keys on them than it can spare;
a set that spent more is poor.  So two members are compared there if the one
with the lesser last salt is poor, or both are where the salts are equal:
block against block, and only pairs that sizes and sketches allow leave a
task.

Edge cases: null or blank text has an empty set, links with nothing and is a
component of its own; texts below five words have their whole word sequence
as the one shingle; repeated rows and exact copies share a class; an empty
table gives an empty result; further columns are ignored.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_text, checkpointed, n_partitions, small
from .components import components
from .textblock import blocks, lean, lean_group, mix, shingle_sets

BAND = 2          # size ratio of a band
SALTS = 8
SMALL = 64        # bands below this size use single-shingle chunks
BLOCK = 1024      # members of a crowded bucket that meet in one task
CROWD = 24        # buckets above this size contribute pairs of poor members only


def max_difference(a, b, t: int):
    return (100 - t) * (a + b) // (100 + t)


def band_of(n: int) -> int:
    """The band of sizes BAND**b .. BAND**(b+1) - 1 that holds n."""
    b = 0
    while BAND ** (b + 1) <= n:
        b += 1
    return b


def _chunks(s: np.ndarray, band: int, salt: int, groups: int, weight: int) -> np.ndarray:
    """Keys of the strong chunks of one set."""
    seed = np.uint64((band * 64 + salt + 1) * 0x9E3779B97F4A7C15 & (2 ** 64 - 1))
    m = mix(s ^ seed)
    chunk = ((m >> np.uint64(32)) * np.uint64(groups)) >> np.uint64(32)
    order = np.argsort(chunk, kind="stable")
    chunk, bits = chunk[order], m[order]
    cut = np.flatnonzero(np.concatenate([[True], chunk[1:] != chunk[:-1]]))
    parity = np.bitwise_xor.reduceat(bits, cut)
    size = np.diff(np.concatenate([cut, [len(bits)]]))
    strong = size >= weight
    return mix(mix(parity[strong] ^ seed) + chunk[cut[strong]])


def dealt(s: np.ndarray, t: int):
    """Of a set (sorted distinct shingle hashes): (band, keys, slack, last
    salt) for every band it is emitted in.  Slack is how many of the keys of
    the last salt the pigeonhole can spare (-1, and the salt after the last,
    where it fell back to shingles)."""
    n = len(s)
    top = 100 * n // t                    # the largest partner
    for band in range(band_of(n), band_of(top) + 1):
        last = BAND ** (band + 1) - 1     # the largest set of the band
        weight = 1 if last < SMALL else 2
        # 1.3 chunks per possible difference keep enough strong chunks;
        # small bands, with single-shingle chunks, take two
        groups = int((1.3 if weight == 2 else 2) * max_difference(last, last, t)) + 2
        most = max_difference(n, min(top, last), t)
        out = []
        for salt in range(SALTS):
            out.append(_chunks(s, band, salt, groups, weight))
            slack = len(out[-1]) - most - 1
            if slack >= 0:
                break
        else:
            slack, salt = -1, SALTS
            out.append(mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5 + band)))
        # the lowest six bits of a key name its band
        yield band, np.concatenate(out) & ~np.uint64(63) | np.uint64(band), slack, salt


def chunk_keys(s: np.ndarray, t: int) -> np.ndarray:
    """All bucket keys of a set."""
    return np.concatenate([keys for _, keys, _, _ in dealt(s, t)])


def dense_sketch(s: np.ndarray) -> bytes:
    """1024 parity bits of a set."""
    bit = (mix(s + np.uint64(77)) >> np.uint64(54)).astype(np.int64)
    return np.packbits(np.bincount(bit, minlength=1024).astype(np.uint8) & 1).tobytes()


def set_id(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _describe(batches):
    """doc_id, n_shingles, sid (128-bit set name), cls (its first 63 bits),
    dense sketch."""
    for batch in batches:
        n, sid, cls, sketch = [], [], [], []
        for _, data, offs in blocks(batch.column("text")):
            for s in shingle_sets(data, offs):
                d = set_id(s) if len(s) else None
                n.append(len(s))
                sid.append(d)
                cls.append(int.from_bytes(d[:8], "little") >> 1 if d else None)
                sketch.append(dense_sketch(s) if d else None)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(sid, pa.binary()),
                                          pa.array(cls, pa.int64()), pa.array(sketch, pa.binary())],
                                         ["doc_id", "n_shingles", "sid", "cls", "sketch"])


def _close(t: int):
    """Of two blocks of a bucket (lo and hi; equal for a block with itself):
    the pairs of different components that could be missed elsewhere and whose
    sizes and dense sketches allow a link.  No other pair leaves the task."""
    def run(table: pa.Table) -> pa.Table:
        rep, comp, n = (table.column(c).to_numpy() for c in ("rep", "component", "n_shingles"))
        block, lo, hi = table.column("block").to_numpy(), table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
        sketch = np.frombuffer(b"".join(x.as_py() for x in table.column("sketch")), np.uint64).reshape(len(rep), -1)
        last, poor = table.column("last").to_numpy(), table.column("poor").to_numpy()
        left, right = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
        xs, ys = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for i in left:
            j = right[(comp[right] != comp[i]) & ((rep[right] > rep[i]) if lo == hi else True)]
            j = j[((last[j] >= last[i]) <= poor[i]) & ((last[j] <= last[i]) <= poor[j])]
            j = j[100 * np.minimum(n[j], n[i]) >= t * np.maximum(n[j], n[i])]
            far = np.bitwise_count(sketch[j] ^ sketch[i]).sum(axis=1)
            j = j[far <= max_difference(n[j], n[i], t)]
            xs.append(np.minimum(rep[j], rep[i]))
            ys.append(np.maximum(rep[j], rep[i]))
        return pa.table({"x": np.concatenate(xs), "y": np.concatenate(ys)})
    return run


def _slack(t: int):
    def run(batches):
        for batch in batches:
            ids, rows = batch.column("doc_id").to_pylist(), []
            for first, data, offs in blocks(batch.column("text")):
                for i, s in enumerate(shingle_sets(data, offs)):
                    rows += [(ids[first + i], band, slack, last) for band, _, slack, last in dealt(s, t)]
            cols = list(zip(*rows)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int32()))],
                                             ["rep", "band", "slack", "last"])
    return run


def _emit(parts: int, t: int):
    def run(batches):
        for batch in batches:
            keys, cls = [], []
            for _, data, offs in blocks(batch.column("text")):
                for s in shingle_sets(data, offs):
                    if len(s):
                        k = chunk_keys(s, t)
                        keys.append(k)
                        cls.append(np.full(len(k), int.from_bytes(set_id(s)[:8], "little") >> 1, np.int64))
            if not keys:
                continue
            k, c = np.concatenate(keys), np.concatenate(cls)
            p = (k % np.uint64(parts)).astype(np.int64)
            order = np.argsort(p, kind="stable")
            k, c = k[order], c[order]
            cut = np.searchsorted(p[order], np.arange(parts + 1))
            full = np.flatnonzero(np.diff(cut))
            yield pa.RecordBatch.from_arrays([
                pa.array(full, pa.int32()),
                pa.array([k[cut[i]:cut[i + 1]].tobytes() for i in full], pa.binary()),
                pa.array([c[cut[i]:cut[i + 1]].tobytes() for i in full], pa.binary())], ["part", "keys", "cls"])
    return run


def _buckets(table: pa.Table) -> pa.Table:
    """Of one hash part: (key, member, leader, size) of every bucket with two
    or more classes, a row for each member but the leader."""
    k = np.concatenate([np.frombuffer(x.as_py(), np.uint64) for x in table.column("keys")] or [np.empty(0, np.uint64)])
    c = np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in table.column("cls")] or [np.empty(0, np.int64)])
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    same = np.zeros(len(k), bool)
    eq = k[1:] == k[:-1]
    same[1:] |= eq
    same[:-1] |= eq
    k, c = k[same], c[same]
    order = np.lexsort((c, k))
    k, c = k[order], c[order]
    if len(k):
        new = np.concatenate([[True], (k[1:] != k[:-1]) | (c[1:] != c[:-1])])
        k, c = k[new], c[new]
        start = np.concatenate([[True], k[1:] != k[:-1]])
        first = np.flatnonzero(start)
        size = np.diff(np.concatenate([first, [len(k)]]))
        lead, size = np.repeat(c[first], size), np.repeat(size, size)
        keep = c != lead
        k, c, lead, size = k[keep], c[keep], lead[keep], size[keep]
    else:
        lead = size = c
    return pa.table({"key": pa.array(k.view(np.int64), pa.int64()), "member": pa.array(c, pa.int64()),
                     "leader": pa.array(lead, pa.int64()), "size": pa.array(size, pa.int64())})


def _verified(texts: DataFrame, classes: DataFrame, pairs: DataFrame, t: int) -> DataFrame:
    """The pairs (a, b) of class names whose sets really link, as pairs of
    representative documents (x, y)."""
    def near(batches):
        for batch in batches:
            keep = []
            for u, v, nu, nv in zip(batch.column("sx"), batch.column("sy"), batch.column("nx").to_pylist(), batch.column("ny").to_pylist()):
                d = np.bitwise_count(np.frombuffer(u.as_py(), np.uint64) ^ np.frombuffer(v.as_py(), np.uint64)).sum()
                keep.append(int(d) <= max_difference(nu, nv, t))
            yield batch.select(["x", "y"]).filter(pa.array(keep, pa.bool_()))

    cx = classes.select(F.col("cls").alias("a"), F.col("rep").alias("x"), F.col("n_shingles").alias("nx"), F.col("sketch").alias("sx"))
    cy = classes.select(F.col("cls").alias("b"), F.col("rep").alias("y"), F.col("n_shingles").alias("ny"), F.col("sketch").alias("sy"))
    p = (pairs.join(cx, "a").join(cy, "b").where(f"x <> y and 100 * least(nx, ny) >= {t} * greatest(nx, ny)")
         .mapInArrow(lean(near), "x long, y long").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct())
    return _linked(texts, p, t)


def _linked(texts: DataFrame, pairs: DataFrame, t: int) -> DataFrame:
    """The pairs (x, y) of documents that really link, by their whole sets."""
    p = checkpointed(pairs)
    need = small(p.select(F.col("x").alias("doc_id")).union(p.select("y")).distinct())

    def sets(batches):
        for batch in batches:
            out = [s.tobytes() for _, data, offs in blocks(batch.column("text")) for s in shingle_sets(data, offs)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary())], ["doc_id", "shingles"])

    def links(batches):
        for batch in batches:
            keep = []
            for u, v in zip(batch.column("u"), batch.column("v")):
                u, v = np.frombuffer(u.as_py(), np.uint64), np.frombuffer(v.as_py(), np.uint64)
                both = len(np.intersect1d(u, v, assume_unique=True))
                keep.append(100 * both >= t * (len(u) + len(v) - both))
            yield batch.select(["x", "y"]).filter(pa.array(keep, pa.bool_()))

    s = checkpointed(texts.join(need, "doc_id", "left_semi").mapInArrow(lean(sets), "doc_id long, shingles binary"))
    return (p.join(s.select(F.col("doc_id").alias("x"), F.col("shingles").alias("u")), "x")
            .join(s.select(F.col("doc_id").alias("y"), F.col("shingles").alias("v")), "y")
            .mapInArrow(lean(links), "x long, y long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = 80,
                    crowd: int = CROWD) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every document; see the module
    text.  ``threshold`` is the Jaccard similarity in percent; ``crowd`` only
    chooses between two exact ways."""
    spark = docs.sparkSession
    texts = as_text(docs, id_col, text_col)
    described = checkpointed(texts.mapInArrow(lean(_describe), "doc_id long, n_shingles long, sid binary, cls long, sketch binary"))
    classes = checkpointed(described.where("sid is not null").groupBy("sid", "cls")
                           .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")))
    parts = 2 * n_partitions(spark)
    buckets = checkpointed(texts.mapInArrow(lean(_emit(parts, threshold)), "part int, keys binary, cls binary")
                           .groupBy("part").applyInArrow(lean_group(_buckets), "key long, member long, leader long, size long"))
    star = buckets.select(F.col("leader").alias("a"), F.col("member").alias("b")).distinct()
    links = checkpointed(_verified(texts, classes, star, threshold))
    comp = checkpointed(components(links, "x", "y"))

    # what the stars left open: buckets with members of different components
    def with_component(rows: DataFrame) -> DataFrame:
        return (rows.join(comp.select(F.col("node").alias("rep"), "component"), "rep", "left")
                .withColumn("component", F.coalesce("component", "rep")))

    def still_mixed(rows: DataFrame) -> DataFrame:
        mixed = (rows.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n"))
                 .where("lo <> hi").select("key", "n"))
        return checkpointed(rows.join(mixed, "key"))

    member = still_mixed(with_component(
        buckets.where("size > 2").select("key", "member")
        .join(classes.select(F.col("cls").alias("member"), "rep"), "member")
        .select("key", "rep", F.col("key").bitwiseAND(63).cast("int").alias("band"))))
    crowded = member.where(F.col("n") > crowd)
    if crowded.take(1):
        # a second star, on the member with most crowded keys: near copies of
        # one text centre on the least edited one
        spent = checkpointed(crowded.groupBy("rep", "band").agg(F.count("*").alias("spent")))
        centre = crowded.join(spent, ["rep", "band"]).groupBy("key").agg(F.max(F.struct("spent", "rep")).getField("rep").alias("centre"))
        star = (crowded.join(centre, "key").where("rep <> centre")
                .select(F.least("rep", "centre").alias("x"), F.greatest("rep", "centre").alias("y")).distinct())
        links = checkpointed(links.union(_linked(texts, star, threshold)).distinct())
        comp = checkpointed(components(links, "x", "y"))
        member = still_mixed(with_component(member.drop("component", "n")))
        crowded = member.where(F.col("n") > crowd)
    open_ = member.where(F.col("n") <= crowd).select("key", "rep", "component")
    other = open_.select("key", F.col("rep").alias("other"), F.col("component").alias("other_component"))
    cross = open_.join(other, "key").where("component <> other_component and rep < other").select(F.col("rep").alias("x"), F.col("other").alias("y"))
    if crowded.take(1):
        spent = checkpointed(crowded.groupBy("rep", "band").agg(F.count("*").alias("spent")))
        need = small(spent.select(F.col("rep").alias("doc_id")).distinct())
        slack = texts.join(need, "doc_id", "left_semi").mapInArrow(lean(_slack(threshold)), "rep long, band int, slack long, last int").distinct()
        state = spent.join(slack, ["rep", "band"]).select("rep", "band", "last", (F.col("spent") > F.col("slack")).alias("poor"))
        judged = checkpointed(crowded.drop("n").join(state, ["rep", "band"]))
        least = judged.where("poor").groupBy("key").agg(F.min("last").alias("least"))
        open_keys = judged.join(least, "key").where("poor or last > least")
        size = open_keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
        chosen = open_keys.join(size, "key").join(classes.select("rep", "n_shingles", "sketch"), "rep")
        # block against block, so that no bucket has to fit into one task
        n_blocks = F.ceil(F.col("n") / BLOCK).cast("int")
        rows = chosen.withColumn("block", F.pmod(F.xxhash64("rep"), n_blocks).cast("int")).withColumn(
            "with", F.explode(F.sequence(F.lit(0), n_blocks - 1)))
        rows = rows.select("key", F.least("block", "with").alias("lo"), F.greatest("block", "with").alias("hi"), "block",
                           "rep", "component", "n_shingles", "sketch", "last", F.col("poor").cast("int").alias("poor"))
        cross = cross.union(rows.groupBy("key", "lo", "hi").applyInArrow(lean_group(_close(threshold)), "x long, y long"))
    more = checkpointed(_linked(texts, cross.distinct(), threshold))
    if more.take(1):
        comp = components(links.union(more), "x", "y")

    of_class = (classes.join(comp.select(F.col("node").alias("rep"), "component"), "rep", "left")
                .select("sid", F.coalesce("component", "rep").alias("component")))
    return (described.join(of_class, "sid", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")))
