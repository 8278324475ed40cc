"""Repair of conversation structure at least cost.

The rows of a conversation, in turn order, are edited until the initials of
the roles read ``(s?(ua)+)?``.  Keep costs 0, Rerole (to user or assistant) 2,
Delete 3, Insert (an empty user or assistant row) 2; a truncated row that
stays adds 1; blank and duplicate rows must go.  Of the cheapest edits the
one whose initials (D, I, K, R) are least in ASCII order wins.

Cost DP.  The pattern has four states (nothing yet, after s, after u, after
a).  A row is a 4 x 4 matrix of least costs from the state before it, inserts
included, to the state behind it; products in the (min, +) algebra over 1, 2,
4, ... rows give every node (row, state) its least cost to the end.

Path ranking.  The arcs that lie on cheapest paths are kept.  Nodes are
ranked by the audit letters of their least path, first by one letter, then by
2, 4, 8, ...: the pair (own rank, rank of the node that many letters on) gives
the next rank, as the pointers double.  The ranks pick the arc of every node,
and doubled pointers of the picked arcs read the whole audit off at once: its
letter j starts at the node reached by the pointers of the bits of j.  No step
follows a conversation row by row.

On Spark.  Rows are range-partitioned on (conversation, turn, ...), so even one
conversation with a third of all rows spreads over many partitions, sorted,
and fixed by a checkpoint.  A conversation that lies in one partition and has
at most ``segment`` rows is done where it lies.  Longer or cut ones go by
segments: summaries of 16 numbers a segment give the costs behind it, each
segment ranks its paths from each of the four states, the states are chained
through the segments, and the chosen edits meet the texts again.  Both ways
give the same result.  The digest of one conversation is serial by definition:
its rows stream through one task, in order, and are never held together.

Edge cases: null role and text are one space, so such rows are blank; a null
conversation id is a conversation of its own; null turns come first and never
make gaps; rows of one turn are ordered by role and text (texts that agree in
64 characters by hash), so equal rows are adjacent; repeated rows are
duplicates; a role that starts with neither s, u nor a can only be reroled or
deleted; no rows, or none left, give zeros or an empty repair with the digest
of the empty string; an empty table gives an empty result; extra columns are
ignored; long texts are never cut.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, n_partitions, small
from .textblock import lean, lean_group, lean_pair

LETTERS = "DIKR"
ROLES = ("", "system", "user", "assistant")
NEXT = np.array([2, 2, 3, 2])                    # the state an inserted or reroled row leads to
KEEP = np.full((4, 4), -1)                       # [state, initial]: the state a kept row leads to
KEEP[0, 1], KEEP[[0, 1, 3], 2], KEEP[2, 3] = 1, 2, 3
LEGAL = np.zeros((4, 4), bool)
LEGAL[[1, 2, 3], [2, 3, 2]] = True               # su, ua, au
CLOSED = np.array([0, 4, 2, 0])                  # least cost to an accepted end
INF = 1 << 40
DELETE, INSERT, REROLE, STAYS = 3, 2, 2, 1
SEGMENT = 16384
INK = r"[^\x20\x09-\x0D]"
_EMPTY = hashlib.sha256(b"").hexdigest()


# --- costs and ranks, over many conversations (or segments) at once --------

def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(min, +) products of stacks of 4 x 4 matrices."""
    return np.minimum((a[:, :, :, None] + b[:, None, :, :]).min(2), INF)


def row_matrices(ini, must, open_) -> np.ndarray:
    """Least costs from each state before a row to each state behind it."""
    n = len(ini)
    w = np.full((n, 4, 4), INF, np.int64)
    rows = np.flatnonzero(~must)
    for q in range(4):
        w[:, q, q] = DELETE
        w[rows, q, NEXT[q]] = REROLE + STAYS * open_[rows]
        to = KEEP[q, ini]
        k = np.flatnonzero(~must & (to >= 0))
        w[k, q, to[k]] = np.minimum(w[k, q, to[k]], STAYS * open_[k])
    one = w[:, NEXT] + INSERT
    return np.minimum(np.minimum(w, one), one[:, NEXT] + INSERT)


def suffix_products(m: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Product of the matrices of rows i .. stop[i] - 1, for every i, by
    doubling."""
    p, reach = m.copy(), np.arange(len(m)) + 1
    while True:
        go = np.flatnonzero(reach < stop)
        if len(go) == 0:
            return p
        p[go], reach[go] = _times(p[go], p[reach[go]]), reach[reach[go]]


class Paths:
    """Least paths through the runs of rows [first[c], first[c + 1]).

    ``future[c]`` holds the least costs from each state behind run c to the
    end; ``closed`` says that the end of the conversation follows, where rows
    may still be inserted."""

    def __init__(self, ini, must, open_, first, future, closed: bool):
        n, runs = len(ini), len(first) - 1
        run = np.repeat(np.arange(runs), np.diff(first))
        self.first, self.n = first, n
        layer = np.arange(n) + run                              # a run of m rows has m + 1 layers
        last = first[1:] + np.arange(runs)
        v = np.empty((n + runs, 4), np.int64)
        v[last] = future
        if n:
            v[layer] = (suffix_products(row_matrices(ini, must, open_), first[run + 1]) + future[run][:, None, :]).min(2)
        self.cost, self.start = v, first[:-1] + np.arange(runs)
        # arcs of every node: cost and target by letter
        node = np.arange(4 * (n + runs)).reshape(-1, 4)
        cost = np.full((n + runs, 4, 4), 4 * INF, np.int64)
        to = np.zeros((n + runs, 4, 4), np.int64)
        may = layer if not closed else np.arange(n + runs)
        live = np.flatnonzero(~must)
        for q in range(4):
            cost[layer, q, 0], to[layer, q, 0] = DELETE + v[layer + 1, q], node[layer + 1, q]
            cost[may, q, 1], to[may, q, 1] = INSERT + v[may, NEXT[q]], node[may, NEXT[q]]
            k = np.flatnonzero(~must & (KEEP[q, ini] >= 0))
            at, t = layer[k], KEEP[q, ini[k]]
            cost[at, q, 2], to[at, q, 2] = STAYS * open_[k] + v[at + 1, t], node[at + 1, t]
            at = layer[live]
            cost[at, q, 3], to[at, q, 3] = REROLE + STAYS * open_[live] + v[at + 1, NEXT[q]], node[at + 1, NEXT[q]]
        best = (cost == v[:, :, None]) & (v < INF)[:, :, None]
        best, to = best.reshape(-1, 4), to.reshape(-1, 4)
        end = ~best.any(1)
        own = np.arange(len(best))
        # rank the nodes by 1, 2, 4, ... letters of their least audit
        letter = np.where(end, 0, best.argmax(1) + 1)
        pointer, rank = np.where(end, own, to[own, best.argmax(1)]), letter
        while True:
            rank = np.unique(rank * (len(rank) + 5) + rank[pointer], return_inverse=True)[1]
            if end[pointer].all():
                break
            pointer = pointer[pointer]
        # the ranks pick the arc: least letter, then least rest
        pick = np.where(best, np.arange(1, 5) * (len(rank) + 1) + rank[to], 8 * (len(rank) + 1)).argmin(1)
        self.letter = np.where(end, 0, pick + 1)
        self.hops = [np.where(end, own, to[own, pick])]
        self.length = (~end).astype(np.int64)
        while not end[self.hops[-1]].all():
            hop = self.hops[-1]
            self.length = self.length + self.length[hop]
            self.hops.append(hop[hop])
        self.length = self.length + self.length[self.hops[-1]]
        self.end_state = self.hops[-1] % 4

    def audits(self, state: int) -> tuple[np.ndarray, np.ndarray]:
        """(letter codes 1..4 of all audits that start in ``state``, in a
        row; offsets of the runs)."""
        begin = self.start * 4 + state
        size = self.length[begin]
        offs = np.concatenate([[0], np.cumsum(size)])
        node, j = np.repeat(begin, size), np.arange(offs[-1]) - np.repeat(offs[:-1], size)
        for k, hop in enumerate(self.hops):
            on = np.flatnonzero(j >> k & 1)
            node[on] = hop[node[on]]
        return self.letter[node], offs


def spelled(codes: np.ndarray) -> str:
    return np.frombuffer(LETTERS.encode(), np.uint8)[codes - 1].tobytes().decode()


def replay(state: int, letters: str, rows):
    """(edit, role, text) of every edit, over the (role, text) of the rows
    it consumes; the state behind it is returned."""
    rows = iter(rows)
    for x in letters:
        if x == "I":
            state = int(NEXT[state])
            yield x, ROLES[state], ""
            continue
        role, text = next(rows)
        if x == "R":
            state = int(NEXT[state])
            role = ROLES[state]
        elif x == "K":
            state = int(KEEP[state, initial(role)])
        yield x, role, text
    return state


def initial(role: str) -> int:
    return " sua".find(role[:1]) if role[:1] in ("s", "u", "a") else 0


# --- damage and row facts ----------------------------------------------------

def damage(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, gone): rows damaged by
    crc32(``conv_id:turn``) % 20.  A dropped row stays as a mark (gone), so
    that its conversation is not forgotten."""
    name = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    h = F.pmod(F.crc32(F.concat(name(id_col), F.lit(":"), name(turn_col)).cast("binary")), F.lit(20))
    rows = conversations.select(F.col(f"`{id_col}`").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
                                name(role_col).alias("role"), name(text_col).alias("text"), h.alias("h"))
    text = F.when(F.col("h") <= 1, "").when(F.col("h") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       (F.col("h") == 0).alias("gone"), F.explode(copies).alias("copy")).drop("copy")


ORDER = ["key", "turn", "role", "head", "hash", "row"]


def in_order(rows: DataFrame) -> DataFrame:
    """The rows with their facts, range-partitioned, sorted and numbered
    (pos); columns key, pos, block, turn, role, text, gone, ini, blank, open."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    ini = F.when(F.substring(role, 1, 1).isin("s", "u", "a"), F.instr(F.lit("sua"), F.substring(role, 1, 1))).otherwise(0)
    x = rows.select(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("key"), "turn", role.alias("role"), text.alias("text"),
                    F.coalesce("gone", F.lit(False)).alias("gone"), ini.cast("int").alias("ini"), (~text.rlike(INK)).alias("blank"),
                    (~text.rlike(r"(?s)[.!?][\x20\x09-\x0D]*\z")).alias("open"), F.substring(text, 1, 64).alias("head"), F.xxhash64(text).alias("hash"),
                    F.monotonically_increasing_id().alias("row"))
    keys = [F.col(c).asc_nulls_first() for c in ORDER]
    x = x.repartitionByRange(n_partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys)
    return checkpointed(x.drop("head", "hash", "row").withColumn("pos", F.monotonically_increasing_id()).withColumn("block", F.spark_partition_id()))


_FACTS = "key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _runs(keys: pa.Array) -> tuple[list, np.ndarray]:
    """Distinct neighbours of a sorted column and where they start."""
    import pyarrow.compute as pc
    n = len(keys)
    new = np.concatenate([[True], pc.not_equal(keys.slice(1), keys.slice(0, n - 1)).to_numpy(zero_copy_only=False)])
    at = np.flatnonzero(new)
    return keys.take(pa.array(at)).to_pylist(), np.concatenate([at, [n]])


def _column(table, name):
    return table.column(name).combine_chunks() if isinstance(table.column(name), pa.ChunkedArray) else table.column(name)


def _gaps(turn: pa.Array, run: np.ndarray, runs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(least, greatest, distinct turns) of each run; distinct 0 where all
    are null."""
    ok = ~turn.is_null().to_numpy(zero_copy_only=False)
    t, r = turn.fill_null(0).to_numpy()[ok].astype(np.int64), run[ok]
    lo, hi = np.zeros(runs, np.int64), np.zeros(runs, np.int64)
    if len(t):
        first = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
        lo[r[first]] = t[first]
        hi[r[first]] = t[np.concatenate([first[1:], [len(t)]]) - 1]
    fresh = np.ones(len(t), bool)
    fresh[1:] = (t[1:] != t[:-1]) | (r[1:] != r[:-1])
    return lo, hi, np.bincount(r[fresh], minlength=runs)


def _facts(table: pa.Table, first: np.ndarray, seen_before=None):
    """Initials, faults and counts of the runs of a table of live rows."""
    n, runs = table.num_rows, len(first) - 1
    run = np.repeat(np.arange(runs), np.diff(first))
    ini = _column(table, "ini").to_numpy().astype(np.int64)
    blank = _column(table, "blank").to_numpy(zero_copy_only=False)
    twice = np.zeros(n, bool)
    seen: set = set(seen_before or ())
    what = _column(table, "digest").to_pylist() if "digest" in table.column_names else list(
        zip(_column(table, "role").to_pylist(), _column(table, "text").to_pylist()))
    for i, x in enumerate(zip(run.tolist(), what)):
        if x in seen:
            twice[i] = True
        else:
            seen.add(x)
    twice &= ~blank
    open_ = _column(table, "open").to_numpy(zero_copy_only=False) & ~blank & ~twice
    pair = run[1:] == run[:-1]
    wrong = np.flatnonzero(pair & ~LEGAL[ini[:-1], ini[1:]]) + 1
    counts = {"blank": blank, "duplicate": twice, "truncated": open_}
    counts = {k: np.bincount(run[x], minlength=runs) for k, x in counts.items()} | {"illegal": np.bincount(run[wrong], minlength=runs)}
    return run, ini, blank | twice, open_, counts


def _whole(batches):
    """Conversations that lie in one partition, sorted by (key, pos)."""
    held: list[pa.RecordBatch] = []
    n = 0

    def done(table: pa.Table):
        keys, first = _runs(_column(table, "key"))
        live = ~_column(table, "gone").to_numpy(zero_copy_only=False)
        first = np.concatenate([[0], np.cumsum(live)])[first]
        table = table.filter(pa.array(live))
        run, ini, must, open_, counts = _facts(table, first)
        runs = len(keys)
        lo, hi, distinct = _gaps(_column(table, "turn"), run, runs)
        paths = Paths(ini, must, open_, first, np.tile(CLOSED, (runs, 1)), True)
        codes, offs = paths.audits(0)
        text = spelled(codes)
        rows = list(zip(_column(table, "role").to_pylist(), _column(table, "text").to_pylist()))
        audits, digests = [], []
        for c in range(runs):
            audits.append(text[offs[c]:offs[c + 1]])
            lines = "\n".join(f"{role}:{t}" for x, role, t in replay(0, audits[-1], rows[first[c]:first[c + 1]]) if x != "D")
            digests.append(hashlib.sha256(lines.encode()).hexdigest())
        cols = [pa.array(keys, pa.string()), np.where(distinct > 0, hi - lo + 1 - distinct, 0), *(counts[k] for k in ("blank", "duplicate", "truncated", "illegal")),
                paths.cost[paths.start, 0], pa.array(audits, pa.string()), pa.array(digests, pa.string())]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in cols], [c.split()[0] for c in _FACTS.split(", ")])

    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n < 8192:
            continue
        table = pa.Table.from_batches(held)
        _, first = _runs(_column(table, "key"))
        cut = int(first[-2])                              # the last conversation may go on
        if cut:
            yield done(table.slice(0, cut))
            held, n = table.slice(cut).combine_chunks().to_batches(), table.num_rows - cut
    if n:
        yield done(pa.Table.from_batches(held))


# --- long conversations, by segments -----------------------------------------

_SEGMENT = ("key string, seg long, first_pos long, ini binary, must binary, open binary, matrix array<long>, first_ini int, last_ini int, lo long, hi long, "
            "turns long, blank long, duplicate long, truncated long, illegal long")


def _segment(left: pa.Table, right: pa.Table) -> pa.Table:
    """Facts of one segment; ``right`` holds the digests seen before it."""
    left = left.take(pa.array(np.argsort(_column(left, "pos").to_numpy(), kind="stable")))
    n = left.num_rows
    first = np.array([0, n])
    run, ini, must, open_, counts = _facts(left, first, [(0, d) for d in _column(right, "d").to_pylist()])
    lo, hi, turns = _gaps(_column(left, "turn"), run, 1)
    whole = suffix_products(row_matrices(ini, must, open_), np.full(n, n))[0]
    row = {"key": left.column("key")[0].as_py(), "seg": left.column("seg")[0].as_py(), "first_pos": left.column("pos")[0].as_py(),
           "ini": ini.astype(np.uint8).tobytes(), "must": must.astype(np.uint8).tobytes(), "open": open_.astype(np.uint8).tobytes(),
           "matrix": whole.ravel().tolist(), "first_ini": int(ini[0]), "last_ini": int(ini[-1]), "lo": int(lo[0]), "hi": int(hi[0]), "turns": int(turns[0]),
           **{k: int(v[0]) for k, v in counts.items()}}
    types = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    return pa.Table.from_pylist([row], pa.schema([(a, types[b]) for a, b in (c.split() for c in _SEGMENT.split(", "))]))


def _behind(table: pa.Table) -> pa.Table:
    """Costs behind each segment of a conversation, and its counts, from the
    summaries in order."""
    rows = sorted(table.to_pylist(), key=lambda r: r["seg"])
    future, out = CLOSED.astype(np.int64), []
    for r in reversed(rows):
        out.append({"key": r["key"], "seg": r["seg"], "future": future.tolist()})
        future = np.minimum((np.array(r["matrix"]).reshape(4, 4) + future[None, :]).min(1), INF)
    total = {k: sum(r[k] for r in rows) for k in ("blank", "duplicate", "truncated", "illegal")}
    total["illegal"] += sum(not LEGAL[a["last_ini"], b["first_ini"]] for a, b in zip(rows, rows[1:]))
    timed = [r for r in rows if r["turns"]]
    turns = sum(r["turns"] for r in timed) - sum(a["hi"] == b["lo"] for a, b in zip(timed, timed[1:]))
    total["gaps"] = timed[-1]["hi"] - timed[0]["lo"] + 1 - turns if timed else 0
    out[-1] |= total | {"cost": int(future[0])}              # the first segment carries what holds for all
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return pa.Table.from_pylist(out, pa.schema([("key", pa.string()), ("seg", pa.int64()), ("future", pa.list_(pa.int64()))] + [(x, pa.int64()) for x in names]))


_BEHIND = "key string, seg long, future array<long>, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"


def _ranked(last_seg_closed):
    """Of each segment the least audit and the state behind it, from each of
    the four states before it."""
    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                ini, must, open_ = (np.frombuffer(r[k], np.uint8) for k in ("ini", "must", "open"))
                paths = Paths(ini.astype(np.int64), must.astype(bool), open_.astype(bool), np.array([0, len(ini)]), np.array([r["future"]]), r[last_seg_closed])
                audits = [spelled(paths.audits(q)[0]) for q in range(4)]
                out.append({"key": r["key"], "seg": r["seg"], "first_pos": r["first_pos"], "audits": audits, "ends": [int(paths.end_state[q]) for q in range(4)]})
            yield pa.RecordBatch.from_pylist(out, pa.schema([("key", pa.string()), ("seg", pa.int64()), ("first_pos", pa.int64()),
                                                             ("audits", pa.list_(pa.string())), ("ends", pa.list_(pa.int64()))]))
    return run


def _chained(table: pa.Table) -> pa.Table:
    """The state in which each segment of a conversation is entered."""
    state, out = 0, []
    for r in sorted(table.to_pylist(), key=lambda r: r["seg"]):
        out.append({"key": r["key"], "seg": r["seg"], "entry": state})
        state = r["ends"][state]
    return pa.Table.from_pylist(out, pa.schema([("key", pa.string()), ("seg", pa.int64()), ("entry", pa.int64())]))


class _Replayed:
    """The replay as a stream: pieces of the audit (``edits``) and rows come
    in the order of their positions."""

    def __init__(self):
        self.state, self.letters, self.at = 0, "", 0

    def inserts(self):
        while self.at < len(self.letters) and self.letters[self.at] == "I":
            self.at += 1
            self.state = int(NEXT[self.state])
            yield "I", ROLES[self.state], ""

    def edits(self, entry: int, letters: str):
        self.state, self.letters, self.at = entry, letters, 0
        yield from self.inserts()

    def row(self, role: str, text: str):
        x = self.letters[self.at]
        self.at += 1
        if x == "R":
            self.state = int(NEXT[self.state])
            role = ROLES[self.state]
        elif x == "K":
            self.state = int(KEEP[self.state, initial(role)])
        yield x, role, text
        yield from self.inserts()


def _stream(batches):
    """(key, edit, role, text) of pieces and rows sorted by (key, pos, tag)."""
    key, now = None, None
    for batch in batches:
        for k, tag, entry, letters, role, text in zip(*(batch.column(c).to_pylist() for c in ("key", "tag", "entry", "letters", "role", "text"))):
            if now is None or k != key:
                key, now = k, _Replayed()
                yield key, None, None, None
            for e in now.edits(entry, letters) if tag == 0 else now.row(role, text):
                yield (key, *e)


def _digests(batches):
    key, h, empty, open_ = None, hashlib.sha256(), True, False
    out = []
    for k, edit, role, text in _stream(batches):
        if edit is None:
            if open_:
                out.append((key, h.hexdigest()))
            key, h, empty, open_ = k, hashlib.sha256(), True, True
        elif edit != "D":
            h.update(("" if empty else "\n").encode())
            h.update(f"{role}:{text}".encode())
            empty = False
    if open_:
        out.append((key, h.hexdigest()))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out]), pa.array([o[1] for o in out])], ["key", "repaired_sha256"])


def _by_segments(rows: DataFrame) -> DataFrame:
    """The same facts for conversations of any length; ``rows`` has a column
    seg and no dropped rows."""
    lean_rows = rows.select("key", "seg", "pos", "turn", "ini", "blank", "open", F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("digest"))
    own = lean_rows.where("not blank").select("key", "seg", "digest").distinct()
    least = own.groupBy("key", "digest").agg(F.min("seg").alias("least"))
    before = own.join(least, ["key", "digest"]).where("seg > least").select(F.col("key").alias("k"), F.col("seg").alias("s"), F.col("digest").alias("d"))

    segs = checkpointed(lean_rows.groupBy("key", "seg").cogroup(before.groupBy("k", "s")).applyInArrow(lean_pair(_segment), _SEGMENT))
    behind = checkpointed(segs.drop("ini", "must", "open", "first_pos").groupBy("key").applyInArrow(lean_group(_behind), _BEHIND))
    last = segs.groupBy("key").agg(F.max("seg").alias("last_seg"))
    ranked = checkpointed(segs.select("key", "seg", "first_pos", "ini", "must", "open").join(behind.select("key", "seg", "future"), ["key", "seg"])
                          .join(last, "key").withColumn("closed", F.col("seg") == F.col("last_seg"))
                          .mapInArrow(lean(_ranked("closed")), "key string, seg long, first_pos long, audits array<string>, ends array<long>"))
    entry = ranked.select("key", "seg", "ends").groupBy("key").applyInArrow(lean_group(_chained), "key string, seg long, entry long")
    pieces = checkpointed(ranked.join(entry, ["key", "seg"]).select("key", "seg", "first_pos", "entry", F.element_at("audits", (F.col("entry") + 1).cast("int")).alias("letters")))
    audit = pieces.groupBy("key").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seg", "letters"))), lambda p: p["letters"]), "").alias("audit"))
    none = F.lit(None)
    both = (pieces.select("key", F.col("first_pos").alias("pos"), F.lit(0).alias("tag"), "entry", "letters", none.cast("string").alias("role"), none.cast("string").alias("text"))
            .unionByName(rows.select("key", "pos", F.lit(1).alias("tag"), none.cast("long").alias("entry"), none.cast("string").alias("letters"), "role", "text")))
    digest = both.repartition("key").sortWithinPartitions("key", "pos", "tag").mapInArrow(lean(_digests), "key string, repaired_sha256 string")
    return (behind.where("cost is not null").drop("seg", "future").join(audit, "key").join(digest, "key")
            .select([c.split()[0] for c in _FACTS.split(", ")]))


def repair(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text and, if
    there are marks of dropped rows, gone): conv_id, gaps, blank, duplicate,
    truncated, illegal, cost, audit, repaired_sha256.  ``segment`` only
    chooses between two ways with one result."""
    kind = dict(rows.dtypes)["conv_id"]
    if "gone" not in rows.columns:
        rows = rows.withColumn("gone", F.lit(False))
    x = in_order(rows.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", "gone"))
    long = small(x.groupBy("key").agg(F.min("block").alias("a"), F.max("block").alias("b"), F.count("*").alias("n"))
                 .where((F.col("a") < F.col("b")) | (F.col("n") > segment)).select("key"))
    found = (x.join(long, "key", "left_anti").sortWithinPartitions("key", "pos")
             .select("key", "pos", "turn", "role", "text", "gone", "ini", "blank", "open").mapInArrow(lean(_whole, 8192), _FACTS))
    if long.take(1):
        cut = x.join(long, "key", "left_semi")
        step = F.expr(f"pos div {segment}")
        found = found.unionByName(_by_segments(cut.where("not gone").withColumn("seg", step)))
        # long conversations of which nothing is left
        zeros = [F.lit(0).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
        gone = cut.groupBy("key").agg(F.min("gone").alias("all")).where("all")
        found = found.unionByName(gone.select("key", *zeros, F.lit("").alias("audit"), F.lit(_EMPTY).alias("repaired_sha256")))
    return found.withColumn("conv_id", F.expr(f"cast(nullif(key, ' ') as {kind})")).select("conv_id", *[c.split()[0] for c in _FACTS.split(", ")][1:])


def repaired_turns(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """The repaired conversations themselves: (conv_id, place, edit, role,
    text) of every row that stays or is inserted, place counting from 0."""
    kind = dict(rows.dtypes)["conv_id"]
    if "gone" not in rows.columns:
        rows = rows.withColumn("gone", F.lit(False))
    live = rows.where("not gone").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", "gone")
    x = in_order(live)
    audit = repair(live, segment).select(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("key"), F.lit(-1).cast("long").alias("pos"), F.lit(0).alias("tag"),
                                         F.lit(0).cast("long").alias("entry"), F.col("audit").alias("letters"), F.lit("").alias("role"), F.lit("").alias("text"))
    both = audit.unionByName(x.select("key", "pos", F.lit(1).alias("tag"), F.lit(0).cast("long").alias("entry"), F.lit("").alias("letters"), "role", "text"))

    def run(batches):
        place, out = 0, []
        for key, edit, role, text in _stream(batches):
            if edit is None:
                place = 0
            elif edit != "D":
                out.append((key, place, edit, role, text))
                place += 1
            if len(out) >= 2000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["key", "place", "edit", "role", "text"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["key", "place", "edit", "role", "text"])

    out = both.repartition("key").sortWithinPartitions("key", "pos", "tag").mapInArrow(lean(run), "key string, place long, edit string, role string, text string")
    return out.withColumn("conv_id", F.expr(f"cast(nullif(key, ' ') as {kind})")).select("conv_id", "place", "edit", "role", "text")
