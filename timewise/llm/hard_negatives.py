"""Hard-negative mining with a multiway hyperplane tree (GNAT).

Scores are integer inner products of quantized vectors.  With a further
coordinate sqrt(M^2 - |x|^2) every row has norm M, and an anchor (further
coordinate 0) is at distance sqrt(|q|^2 + M^2 - 2 score) of it: a window of
scores is an annulus of distances around the anchor.

The tree.  A node has up to ``ways`` split points, far apart in a sample; a row
goes to the nearest (the cells are bounded by hyperplanes).  For each pair of
siblings i, j the node stores the range of distances from split point i to the
rows of subtree j.  By the triangle inequality subtree j can be left out of a
search as soon as, for one i, no distance d(q, x) that the range allows lies in
the annulus.  Split points come from a bounded sample (``SAMPLE`` rows, by hash
of the id); every row is indexed and every range is taken over all rows, so the
search is exact.

On Spark.  Leaves are cut into cells of about ``CELL`` rows (by hash of the id,
so a vector that fills a third of the table fills many cells).  Requests and
rows meet by cell, sorted rows first: a task holds the rows of one cell and
streams the requests past them, however many there are.  Searches first look
at the anchor's own cell; what they find narrows the annulus of the search in
the other cells, and only the best few of a cell leave it.  Positives come
first, then the windows of all positives of an anchor go together.

Edge cases: rows with a null id, label or vector, or with a null or non-finite
component, take no part; components beyond the range of long are clamped to
it; vectors of different lengths count as padded with zeros; of rows that
repeat an id one counts (the least by label and vector); an anchor never is
its own positive; fewer rows than asked for are returned whole; equal scores go
by id; a positive with a negative score has no window; an empty table or one
without anchors gives an empty result; extra columns are ignored.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed
from .textblock import lean

SAMPLE = 8000        # rows the split points are chosen from
CELL = 4096          # rows of a cell
LOWEST, HIGHEST = -(1 << 62), 1 << 62


# --- the tree -----------------------------------------------------------------

@dataclass
class Tree:
    """points[v]: split points of node v (augmented); child[v]: for each a
    node (>= 0) or a leaf (-1 - leaf); lo, hi, size: ranges [v][i, j] and rows
    [v][j], filled in by ``set_ranges``."""
    points: list[np.ndarray]
    child: list[np.ndarray]
    leaves: int
    norm: float                      # M
    lo: list[np.ndarray] | None = None
    hi: list[np.ndarray] | None = None

    def lifted(self, x: np.ndarray) -> np.ndarray:
        """Rows with their further coordinate."""
        rest = self.norm ** 2 - (x * x).sum(1)
        return np.concatenate([x, np.sqrt(np.maximum(rest, 0))[:, None]], 1)

    @staticmethod
    def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        d = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
        return np.sqrt(np.maximum(d, 0))

    def walk(self, x: np.ndarray):
        """(node, rows of x there, their distances, their child) down the tree."""
        todo = [(0, np.arange(len(x)))] if self.points else []
        while todo:
            v, rows = todo.pop()
            d = self.distances(x[rows], self.points[v])
            c = d.argmin(1)
            yield v, rows, d, c
            for j, to in enumerate(self.child[v]):
                if to >= 0 and (c == j).any():
                    todo.append((int(to), rows[c == j]))

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), np.int64)
        for v, rows, _, c in self.walk(x):
            to = self.child[v][c]
            out[rows[to < 0]] = -1 - to[to < 0]
        return out

    def survivors(self, q: np.ndarray, near: np.ndarray, far: np.ndarray) -> np.ndarray:
        """[request, leaf]: leaves that may hold a row whose distance from the
        anchor q lies in [near, far]."""
        slack = 1e-6 * max(1.0, self.norm)
        near, far = (near - slack)[:, None], (far + slack)[:, None]
        if not self.points:
            return np.ones((len(q), 1), bool)
        alive = [np.zeros(len(q), bool) for _ in self.points]
        alive[0][:] = True
        out = np.zeros((len(q), self.leaves), bool)
        lifted = np.concatenate([q, np.zeros((len(q), 1))], 1)
        for v in range(len(self.points)):
            rows = np.flatnonzero(alive[v])
            if len(rows) == 0:
                continue
            d = self.distances(lifted[rows], self.points[v])
            for j, to in enumerate(self.child[v]):
                lo, hi = self.lo[v][:, j], self.hi[v][:, j]
                if not hi[0] >= lo[0]:                       # no row below
                    continue
                gone = (d - hi > far[rows]) | (lo - d > far[rows]) | (d + hi < near[rows])
                keep = rows[~gone.any(1)]
                if to >= 0:
                    alive[to][keep] = True
                else:
                    out[keep, -1 - to] = True
        return out


def far_apart(x: np.ndarray, k: int) -> np.ndarray:
    """Indices of k rows, each next the farthest from those before it."""
    pick = [0]
    d = Tree.distances(x, x[:1])[:, 0]
    while len(pick) < k:
        i = int(d.argmax())
        if d[i] <= 0:
            break
        pick.append(i)
        d = np.minimum(d, Tree.distances(x, x[i:i + 1])[:, 0])
    return np.array(pick)


def grow(sample: np.ndarray, rows: int, norm: float, ways: int = 8, leaf_rows: int = CELL) -> Tree:
    """The tree over a sample that stands for ``rows`` rows."""
    tree = Tree([], [], 0, norm)
    x = tree.lifted(sample)
    share = rows / max(1, len(x))

    def build(mine: np.ndarray) -> int:
        points = far_apart(x[mine], ways) if len(mine) * share > leaf_rows and len(mine) >= 2 * ways else mine[:0]
        if len(points) < 2:
            tree.leaves += 1
            return -tree.leaves
        v = len(tree.points)
        tree.points.append(x[mine[points]])
        tree.child.append(np.zeros(len(points), np.int64))
        c = Tree.distances(x[mine], tree.points[v]).argmin(1)
        for j in range(len(points)):
            tree.child[v][j] = build(mine[c == j])
        return v

    build(np.arange(len(x)))
    return tree


# --- Spark --------------------------------------------------------------------

def _matrix(column, kind: str, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    raw = b"".join(x.as_py() for x in column)
    return np.frombuffer(raw, kind).reshape(len(column), dim)


def quantized(rows: DataFrame, id_col: str, label_col: str, vec_col: str, scale: int) -> DataFrame:
    """(id, label, v) of the rows that take part."""
    x = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"),
                    F.col(f"`{vec_col}`").cast("array<double>").alias("v")).where("id is not null and label is not null and v is not null")
    finite = F.forall("v", lambda y: y.isNotNull() & ~F.isnan(y) & (F.abs(y) != float("inf")))
    return x.where(finite).select("id", "label", F.transform("v", lambda y: F.floor(y * scale).cast("long")).alias("v"))


def once(rows: DataFrame) -> DataFrame:
    """One row per id: where an id repeats, the least by label and vector."""
    twice = checkpointed(rows.groupBy("id").count().where("count > 1").select("id"))
    if not twice.take(1):
        return rows
    least = rows.join(twice, "id", "left_semi").groupBy("id").agg(F.min(F.struct("label", "v")).alias("x")).select("id", "x.label", "x.v")
    return rows.join(twice, "id", "left_anti").unionByName(least.select("id", "label", "v"))


def _packed(rows: DataFrame, kind: str, dim: int) -> DataFrame:
    """Vectors as bytes of one length."""
    def run(batches):
        for b in batches:
            out = []
            for v in b.column("v").to_pylist():
                x = np.zeros(dim, kind)
                x[:len(v)] = v
                out.append(x.tobytes())
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("label"), pa.array(out, pa.binary()), b.column("anchor")], ["id", "label", "vec", "anchor"])
    return rows.mapInArrow(lean(run), "id long, label long, vec binary, anchor boolean")


@dataclass
class Index:
    rows: DataFrame                  # id, label, vec, anchor, leaf, cell
    tree: Tree
    first: np.ndarray                # first cell of each leaf, and the end
    kind: str
    dim: int
    exact: bool                      # float products are exact


def build_index(rows: DataFrame, anchor: Column, ways: int = 8, cell_rows: int = CELL, sample_rows: int = SAMPLE) -> Index | None:
    """The tree over (id, label, v), all rows in their cells; None where
    there is no row."""
    s = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim"), F.max(F.array_max(F.transform("v", lambda x: F.abs(x)))).alias("most"),
                 F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))).alias("norm2")).first()
    if not s["n"]:
        return None
    dim, most = max(1, s["dim"]), s["most"] or 0
    kind = "<i2" if most < 1 << 15 else "<i8"
    packed = _packed(rows.withColumn("anchor", F.coalesce(anchor, F.lit(False))), kind, dim)
    bits = 1 << 30
    some = packed.where(F.pmod(F.xxhash64("id"), F.lit(bits)) < int(min(1.0, sample_rows / s["n"]) * bits) + 1).select("id", "vec").limit(2 * sample_rows)
    sample = sorted((r["id"], bytes(r["vec"])) for r in some.collect())
    x = np.frombuffer(b"".join(v for _, v in sample), kind).reshape(-1, dim).astype(np.float64)
    tree = grow(x, s["n"], float(np.sqrt(s["norm2"] or 0.0)), ways, cell_rows)

    def assign(batches):
        for b in batches:
            y = tree.lifted(_matrix(b.column("vec"), kind, dim).astype(np.float64))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(tree.leaf_of(y))], ["id", "label", "vec", "anchor", "leaf"])

    placed = checkpointed(packed.mapInArrow(lean(assign), "id long, label long, vec binary, anchor boolean, leaf long"))
    sizes = {r["leaf"]: r["count"] for r in placed.groupBy("leaf").count().collect()}          # one row a leaf
    cells = np.array([max(1, -(-sizes.get(k, 0) // cell_rows)) for k in range(tree.leaves)])
    first = np.concatenate([[0], np.cumsum(cells)])
    start, many = (F.element_at(F.array(*[F.lit(int(c)) for c in a]), (F.col("leaf") + 1).cast("int")) for a in (first[:-1], cells))
    placed = placed.withColumn("cell", start + F.pmod(F.xxhash64("id"), many).cast("int"))
    tree.lo, tree.hi = ([np.full((len(p), len(p)), z) for p in tree.points] for z in (np.inf, -np.inf))

    def ranges(batches):
        lo, hi = ([np.full((len(p), len(p)), z) for p in tree.points] for z in (np.inf, -np.inf))
        for b in batches:
            for v, _, d, c in tree.walk(tree.lifted(_matrix(b.column("vec"), kind, dim).astype(np.float64))):
                for j in np.unique(c):
                    lo[v][:, j] = np.minimum(lo[v][:, j], d[c == j].min(0))
                    hi[v][:, j] = np.maximum(hi[v][:, j], d[c == j].max(0))
        found = [(v, i, int(j), lo[v][i, j], hi[v][i, j]) for v in range(len(lo)) for i, j in np.argwhere(hi[v] >= lo[v])]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], ["v", "i", "j", "lo", "hi"])

    if tree.points:                  # ways^2 rows a node
        for r in (placed.select("vec").mapInArrow(lean(ranges), "v long, i long, j long, lo double, hi double").groupBy("v", "i", "j")
                  .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect()):
            tree.lo[r["v"]][r["i"], r["j"]], tree.hi[r["v"]][r["i"], r["j"]] = r["lo"], r["hi"]
    return Index(placed, tree, first, kind, dim, most * most * dim < 1 << 53)


WINDOWS = "array<struct<name:bigint,lo:bigint,hi:bigint>>"
REQUEST = f"id long, label long, vec binary, cell int, windows {WINDOWS}"


def _route(index: Index, requests: DataFrame) -> DataFrame:
    """The requests (id, label, vec, windows) at every cell that may hold a
    row in one of their windows."""
    tree, first, kind, dim = index.tree, index.first, index.kind, index.dim

    def run(batches):
        for b in batches:
            q = _matrix(b.column("vec"), kind, dim).astype(np.float64)
            w = b.column("windows")
            size = np.diff(w.offsets.to_numpy())
            at = np.repeat(np.arange(len(q)), size)
            lo, hi = (w.flatten().field(c).to_numpy().astype(np.float64) for c in ("lo", "hi"))
            top = (q * q).sum(1)[at] + tree.norm ** 2
            alive = tree.survivors(q[at], np.sqrt(np.maximum(top - 2 * hi, 0)), np.sqrt(np.maximum(top - 2 * lo, 0)))
            any_ = np.zeros((len(q), tree.leaves), bool)
            np.logical_or.at(any_, at, alive)
            who, leaf = np.nonzero(any_)
            n = first[leaf + 1] - first[leaf]
            cell = np.repeat(first[leaf], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            out = pa.Table.from_batches([b]).take(pa.array(np.repeat(who, n))).append_column("cell", pa.array(cell.astype(np.int32)))
            yield from out.select(["id", "label", "vec", "cell", "windows"]).combine_chunks().to_batches()

    return requests.mapInArrow(lean(run, 200), REQUEST)


def _search(index: Index, requests: DataFrame, top: int, same: bool) -> DataFrame:
    """(id, name, other, score): of every request, window and cell the best
    ``top`` rows in the window, of the same label or of another one."""
    kind, dim, exact = index.kind, index.dim, index.exact
    none = F.lit(None)
    both = (index.rows.select("cell", F.lit(0).alias("tag"), "id", "label", "vec", none.cast(WINDOWS).alias("windows"))
            .unionByName(requests.select("cell", F.lit(1).alias("tag"), "id", "label", "vec", "windows")))

    def best(s: np.ndarray, ids: np.ndarray, ok: np.ndarray):
        i = np.flatnonzero(ok)
        if len(i) > top:
            i = i[s[i] >= np.partition(s[i], len(i) - top)[len(i) - top]]
        return i[np.lexsort((ids[i], -s[i]))][:top]

    def run(batches):
        cell, held, ready = None, [], None
        for b in batches:
            cells, tags = b.column("cell").to_numpy(), b.column("tag").to_numpy()
            cut = np.flatnonzero(np.concatenate([[True], (cells[1:] != cells[:-1]) | (tags[1:] != tags[:-1])]))
            for a, z in zip(cut, np.concatenate([cut[1:], [len(cells)]])):
                part = b.slice(a, z - a)
                if cells[a] != cell:
                    cell, held, ready = cells[a], [], None
                if tags[a] == 0:
                    held.append((part.column("id").to_numpy(), part.column("label").to_numpy(), _matrix(part.column("vec"), kind, dim)))
                    continue
                if not held:
                    continue
                if ready is None:
                    ids, labels, x = (np.concatenate(c) for c in zip(*held))
                    ready = ids, labels, x.astype(np.float64 if exact else object).T
                ids, labels, x = ready
                for begin in range(0, part.num_rows, 256):
                    ask = part.slice(begin, 256)
                    score = _matrix(ask.column("vec"), kind, dim).astype(np.float64 if exact else object) @ x
                    out = []
                    for s, name, label, windows in zip(score, ask.column("id").to_pylist(), ask.column("label").to_pylist(), ask.column("windows").to_pylist()):
                        fits = (labels == label) & (ids != name) if same else labels != label
                        for w in windows:
                            i = best(s, ids, fits & (s >= w["lo"]) & (s <= w["hi"]))
                            out += [(name, w["name"], int(ids[k]), int(max(min(s[k], HIGHEST), LOWEST))) for k in i]
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["id", "name", "other", "score"])

    return both.repartition("cell").sortWithinPartitions("cell", "tag").mapInArrow(lean(run), "id long, name long, other long, score long")


def _ranked(found: DataFrame, top: int) -> DataFrame:
    w = Window.partitionBy("id", "name").orderBy(F.desc("score"), "other")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def _narrowed(index: Index, requests: DataFrame, top: int, same: bool) -> DataFrame:
    """The best ``top`` rows of every window: the anchor's own cell first,
    then all cells that may hold better ones."""
    own = _search(index, requests.select("id", "label", "vec", "cell", "windows"), top, same)
    enough = own.groupBy("id", "name").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") >= top).select("id", "name", "least")
    single = requests.select("id", F.explode("windows").alias("w")).select("id", "w.*")
    narrow = (single.join(enough, ["id", "name"], "left")
              .groupBy("id").agg(F.collect_list(F.struct("name", F.greatest("lo", F.coalesce("least", "lo")).alias("lo"), "hi")).alias("windows")))
    asked = checkpointed(requests.drop("windows", "cell").join(narrow, "id"))
    return checkpointed(_ranked(_search(index, _route(index, asked), top, same), top))


def mine(rows: DataFrame, anchor: Column, id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding", scale: int = 256,
         positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, ways: int = 8, cell_rows: int = CELL) -> DataFrame:
    """Hard negatives of the rows that ``anchor`` (a condition on ``id``)
    chooses: (anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score), the first ``negatives`` rows of another label with
    ``low`` <= 100 * score / positive score <= ``high`` for each of the first
    ``positives`` rows of the anchor's label."""
    spark = rows.sparkSession
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    index = build_index(once(quantized(rows, id_col, label_col, vec_col, scale)), anchor, ways, cell_rows)
    if index is None:
        return spark.createDataFrame([], out)
    anchors = index.rows.where("anchor").select("id", "label", "vec", "cell")

    def window(name, lo, hi):
        return F.struct(name.cast("long").alias("name"), lo.cast("long").alias("lo"), hi.cast("long").alias("hi"))

    whole = F.array(window(F.lit(0), F.lit(LOWEST), F.lit(HIGHEST)))
    near = _narrowed(index, anchors.withColumn("windows", whole), positives, True)
    lo, hi = (F.expr(f"cast({f}(cast(score as decimal(30,0)) * {x} / 100) as long)") for f, x in (("ceil", low), ("floor", high)))
    windows = near.where("score >= 0").groupBy("id").agg(F.collect_list(window(F.col("other"), lo, hi)).alias("windows"))
    far = _narrowed(index, anchors.join(windows, "id"), negatives, False)
    pairs = near.select(F.col("id").alias("anchor_id"), F.col("other").alias("positive_id"), F.col("score").alias("positive_score"))
    return (far.select(F.col("id").alias("anchor_id"), F.col("name").alias("positive_id"), "rank", F.col("other").alias("negative_id"), F.col("score").alias("negative_score"))
            .join(pairs, ["anchor_id", "positive_id"]).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"))
