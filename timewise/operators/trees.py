"""Histogram trees: best-first boosting, depth-wise boosting and forests
(SURVEY I1-I3, I7), many models at a time.

Features are cut at quantiles into at most 256 bins, so a row is a few bytes,
and rows travel in blocks of bytes.  A node is judged by its histogram (count
and gradient sum per feature and bin); the histogram of the smaller child is
counted, the sibling's is the parent's minus that.

Best-first growth.  The node with the largest gain is split next, until
``leaves`` leaves stand.  Splits of a node do not depend on other nodes, so
whole waves are judged together: the order is played through with the gains
known so far, and the children of every node that is split in it and was not
judged yet are counted in one go.  A node that is not split among those known
cannot be split once more are known, so the tree is that of one split at a
time, in as many waves as it has levels.  Without a limit of leaves this is depth-wise
growth.

On Spark, two ways with one result:

* up to ``TASK_ROWS`` training rows a model is fitted in one task, and all
  models (folds, trials, trees of a forest) are fitted side by side: blocks are
  joined with the models of their frame and grouped by model;
* beyond that every wave is one job over all blocks: tasks count the
  histograms asked for, of all models at once, a shuffle adds them up by model,
  and only sums reach the driver.  Predictions so far stand beside the blocks
  in a table that is written anew every few trees, so a lost executor repeats
  little.
"""
from __future__ import annotations

import heapq
from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timewise.session import ensure_checkpoint_dir

TASK_ROWS = 2_000_000    # rows of a model that may be fitted in one task: some 20 bytes a row and 2 a column
FEW_ROWS = 1_500         # rows of a node below which all its columns are counted in one call
BLOCK_ROWS = 8192
TOGETHER = 16            # models that share the passes of the second way
RENEW = 10               # trees between two checkpoints there


@dataclass(frozen=True)
class TreeParams:
    """``rounds`` trees of at most ``leaves`` leaves (0: no limit) and
    ``depth`` levels; ``min_rows`` in a leaf, ``min_split`` in a node that is
    split; ``alpha``, ``lam``: L1 and L2 penalties of a leaf; ``rows``,
    ``cols``: shares of rows and columns per tree.  A forest draws rows with
    replacement and columns per node, and averages."""
    rounds: int = 300
    rate: float = 0.05
    leaves: int = 31
    depth: int = 8
    min_rows: int = 20
    min_split: int = 2
    alpha: float = 0.1
    lam: float = 0.1
    rows: float = 0.8
    cols: float | str = 0.8
    forest: bool = False
    bins: int = 64
    seed: int = 42

    def n_cols(self, p: int) -> int:
        if self.cols in ("sqrt", "log2"):
            return max(1, int(np.sqrt(p) if self.cols == "sqrt" else np.log2(p)))
        return max(1, int(round(float(self.cols) * p)))


@dataclass
class Trees:
    """Fitted trees: per node the feature (-1: leaf), threshold (left where
    value <= threshold; null and NaN go right), left child (the right one
    follows it), value and gain; trees follow one another."""
    base: float
    first: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    rows: np.ndarray

    def tree(self, t: int) -> slice:
        return slice(self.first[t], self.first[t + 1])

    def __len__(self) -> int:
        return len(self.first) - 1

    @cached_property
    def _packed(self) -> tuple[dict, np.ndarray]:
        """The cuts of each feature in order, and each node as one number: left
        child, place of its cut among them, feature.  A leaf leads to itself."""
        cuts, place = {}, np.full(len(self.cut), (1 << 24) - 1)
        for j in np.unique(self.feature[self.feature >= 0]).tolist():
            mine = self.feature == j
            cuts[j] = np.unique(self.cut[mine])
            place[mine] = np.searchsorted(cuts[j], self.cut[mine], "left")
        inner = self.feature >= 0
        own = np.arange(len(self.cut)) - np.repeat(self.first[:-1], np.diff(self.first))
        left = np.where(inner, self.left, own)
        if max((len(c) for c in cuts.values()), default=0) >= 1 << 24 or left.max(initial=0) >= 1 << 23 or max(cuts, default=0) >= 1 << 16:
            raise ValueError("too many cuts, nodes or features")
        return cuts, left.astype(np.int64) << 40 | place.astype(np.int64) << 16 | np.where(inner, self.feature, 0)

    def predict(self, x: np.ndarray) -> np.ndarray:
        """All rows go down a tree a level at a time, comparing places among
        the feature's cuts; a leaf leads to itself."""
        n, p = x.shape
        cuts, nodes = self._packed
        ranks = np.empty((n, p), np.min_scalar_type(max((len(c) for c in cuts.values()), default=0)))
        for j in range(p):
            ranks[:, j] = np.searchsorted(cuts[j], x[:, j], "left") if j in cuts else 0
        ranks, row, out = ranks.ravel(), np.arange(n) * p, np.full(n, self.base)
        for t in range(len(self)):
            s = self.tree(t)
            tree, value, deep, left = nodes[s], self.value[s], self.feature[s] >= 0, self.left[s]
            at, level = np.zeros(n, np.int64), np.zeros(1, np.intp)
            while (level := level[deep[level]]).size:
                node = tree.take(at)
                at = (node >> 40) + (ranks.take((node & 0xFFFF) + row) > (node >> 16 & 0xFFFFFF))
                level = np.concatenate([left[level], left[level] + 1])
            out += value.take(at)
        return out

    def pack(self) -> dict:
        return {"base": self.base, **{k: getattr(self, k).tolist() for k in ("first", "feature", "cut", "left", "value", "gain", "rows")}}

    @staticmethod
    def unpack(d: dict) -> "Trees":
        kinds = {"first": np.int64, "feature": np.int64, "left": np.int64}
        return Trees(float(d["base"]), *(np.array(d[k], kinds.get(k, np.float64)) for k in ("first", "feature", "cut", "left", "value", "gain", "rows")))


# --- one tree -------------------------------------------------------------------

def _shrunk(g, alpha: float):
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


def best_splits(hist: np.ndarray, use: np.ndarray, p: TreeParams):
    """(gain, feature, bin) of the best split of each node; ``hist`` is
    [node, column, bin, (rows, gradient)], ``use`` [node, column]."""
    below = np.cumsum(hist, 2)
    nl, gl = below[..., 0], below[..., 1]
    nt, gt = nl[:, :, -1:], gl[:, :, -1:]
    nr, gr = nt - nl, gt - gl
    alpha, lam = (0.0, 0.0) if p.forest else (p.alpha, p.lam)

    def worth(s, m):
        s = s if alpha == 0 else np.maximum(np.abs(s) - alpha, 0.0)
        return s * s / (m + (lam + 1e-300))

    gain = worth(gl, nl) + worth(gr, nr) - worth(gt, nt)
    gain[(nl < max(1, p.min_rows)) | (nr < max(1, p.min_rows)) | ~use[:, :, None]] = 0.0
    gain = gain.reshape(len(hist), -1)
    at = gain.argmax(1)
    return gain[np.arange(len(hist)), at], at // hist.shape[2], at % hist.shape[2]


def _tree_columns(columns: int, t: int, p: TreeParams) -> np.ndarray:
    out = np.zeros(columns, bool)
    out[np.random.default_rng([p.seed, t, 0]).permutation(columns)[:p.n_cols(columns)]] = True
    return out


def grow(root: np.ndarray, t: int, p: TreeParams):
    """A generator that grows tree ``t`` from the histogram of its root.  It
    yields waves, lists of (node, column, bin, child to count), is sent their
    histograms, and returns {node: (column, bin, value, gain, rows)}, column
    -1 for a leaf.  The children of node c are 2c and 2c + 1; the root is 1.
    Nodes too deep or too small to be split are never counted."""
    columns = root.shape[0]
    tree_cols = _tree_columns(columns, t, p)

    def usable(codes):
        if not p.forest:
            return np.tile(tree_cols, (len(codes), 1))
        out = np.zeros((len(codes), columns), bool)
        for i, c in enumerate(codes):
            out[i, np.random.default_rng([p.seed, t, c]).permutation(columns)[:p.n_cols(columns)]] = True
        return out

    hists, sums, split, judged = {1: root}, {1: root[0].sum(0)}, {}, set()
    fewest = max(2 * p.min_rows, p.min_split, 2)

    def may_split(c):
        return sums[c][0] >= fewest and c.bit_length() <= p.depth

    def judge(codes):
        for k in range(0, len(codes), 256):
            part = codes[k:k + 256]
            for c, gain, f, b in zip(part, *best_splits(np.stack([hists[c] for c in part]), usable(part), p)):
                split[c] = (float(gain), int(f), int(b))

    def played():
        """The nodes that best-first growth splits, as far as it is known."""
        out, heap = [], [(-split[1][0], 1)] if 1 in split else []
        while heap and (not p.leaves or len(out) < p.leaves - 1):
            gain, c = heapq.heappop(heap)
            if gain >= -1e-12:
                break
            out.append(c)
            for child in (2 * c, 2 * c + 1):
                if child in split:
                    heapq.heappush(heap, (-split[child][0], child))
        return out

    if may_split(1):
        judge([1])
    while True:
        chosen = played()
        wave = [c for c in chosen if c not in judged]
        if not wave:
            break
        ask, judged = [], judged | set(wave)
        for c in wave:
            _, f, b = split[c]
            sums[2 * c] = hists[c][f, :b + 1].sum(0)
            sums[2 * c + 1] = sums[c] - sums[2 * c]
            if may_split(2 * c) or may_split(2 * c + 1):
                ask.append((c, f, b, 2 * c if sums[2 * c][0] <= sums[2 * c + 1][0] else 2 * c + 1))
        if ask:
            for (c, _, _, small), h in zip(ask, (yield ask)):
                hists[small], hists[small ^ 1] = h, hists[c] - h
            judge([k for c, *_ in ask for k in (2 * c, 2 * c + 1) if may_split(k)])
        for c in wave:
            del hists[c]
    chosen, out = set(chosen), {}
    for c in sorted({1} | {k for c in chosen for k in (2 * c, 2 * c + 1)}):
        n, g = sums[c]
        if c in chosen:
            out[c] = (split[c][1], split[c][2], 0.0, split[c][0], float(n))
        else:
            value = -g / max(n, 1e-300) if p.forest else -p.rate * _shrunk(g, p.alpha) / (n + p.lam + 1e-300)
            out[c] = (-1, 0, float(value), 0.0, float(n))
    return out


def assemble(base: float, grown: Sequence[dict], edges: Sequence[np.ndarray]) -> Trees:
    first, cols = [0], {k: [] for k in ("feature", "cut", "left", "value", "gain", "rows")}
    for tree in grown:
        order, at = [1], {1: 0}
        for c in order:                        # children follow each other
            if tree[c][0] >= 0:
                at[2 * c] = len(order)
                order += [2 * c, 2 * c + 1]
        for c in order:
            f, b, value, gain, n = tree[c]
            cut = float(edges[f][b]) if f >= 0 and b < len(edges[f]) else float("inf")
            for k, x in zip(cols, (f, cut if f >= 0 else 0.0, at.get(2 * c, 0), value, gain, n)):
                cols[k].append(x)
        first.append(first[-1] + len(order))
    kinds = {"feature": np.int64, "left": np.int64}
    return Trees(base, np.array(first), **{k: np.array(v, kinds.get(k, np.float64)) for k, v in cols.items()})


# --- rows as blocks --------------------------------------------------------------

def bin_rows(x: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    """[row, column] bins: the number of edges below the value (NaN: all)."""
    out = np.empty(x.shape, np.uint8)
    for j, e in enumerate(edges):
        out[:, j] = np.searchsorted(e, x[:, j], "left")
    return out


def row_weights(block: int, n: int, t: int, p: TreeParams) -> np.ndarray:
    """How often each row of a block counts in tree ``t``."""
    rng = np.random.default_rng([p.seed, t, 1, block])
    if p.forest:
        return rng.poisson(1.0, n).astype(np.float64)
    return (rng.random(n) < p.rows).astype(np.float64) if p.rows < 1 else np.ones(n)


class Counter:
    """Histograms of the nodes of one growing tree over rows; ``bins`` is
    [column, row].  Every node knows its rows: those that count in the tree,
    and apart from them the rest, which only look for their leaf at the end.
    Columns that the tree does not use stay empty.  A cell adds its rows up in
    their order, however many there are."""

    def __init__(self, bins: np.ndarray, n_bins: int = 0, weight: np.ndarray | None = None, gradient: np.ndarray | None = None,
                 columns: np.ndarray | None = None):
        self.bins, self.w, self.g, self.n_bins = bins, weight, gradient, n_bins
        self.plain = weight is None or bool(((weight == 1) | (weight == 0)).all())
        every = columns is None or len(columns) == len(bins)
        self.columns = np.arange(len(bins)) if every else columns
        self.used = bins if every else bins[columns]
        counts = np.ones(bins.shape[1], bool) if weight is None else weight > 0
        self.rows, self.rest = {1: np.flatnonzero(counts)}, {1: np.flatnonzero(~counts)}

    def count(self, rows: np.ndarray) -> np.ndarray:
        g, w = self.g.take(rows), None if self.plain else self.w.take(rows)
        g = g if w is None else g * w
        k, out = len(self.columns), np.zeros((len(self.bins), self.n_bins, 2))
        if len(rows) < FEW_ROWS:               # one call for all columns
            cells = np.add(self.used[:, rows], (np.arange(k) * self.n_bins)[:, None], dtype=np.intp).ravel()
            n = np.bincount(cells, None if w is None else np.tile(w, k), k * self.n_bins)
            out[self.columns] = np.stack([n, np.bincount(cells, np.tile(g, k), k * self.n_bins)], -1).reshape(k, self.n_bins, 2)
            return out
        for j, column in zip(self.columns, self.used):
            cells = column.take(rows).astype(np.intp)
            out[j, :, 0] = np.bincount(cells, w, self.n_bins)
            out[j, :, 1] = np.bincount(cells, g, self.n_bins)
        return out

    def split(self, ask, rows: dict | None = None):
        rows = self.rows if rows is None else rows
        for c, f, b, *_ in ask:
            mine = rows.pop(c)
            right = self.bins[f].take(mine) > b
            rows[2 * c], rows[2 * c + 1] = mine[~right], mine[right]

    def wave(self, ask) -> list[np.ndarray]:
        """Split the asked nodes and count the asked children."""
        self.split(ask)
        return [self.count(self.rows[a[3]]) for a in ask]

    def leaves(self, tree: dict):
        """(rows, value) of every leaf of the grown tree."""
        def under(c, known):                   # a leaf may have been split on trial
            return [known[c]] if c in known else under(2 * c, known) + under(2 * c + 1, known)

        for known in (self.rows, self.rest):
            todo = [1]
            while todo:
                c = todo.pop()
                if tree[c][0] < 0:
                    for rows in under(c, known):
                        yield rows, tree[c][2]
                    continue
                if c in known:
                    self.split([(c, *tree[c][:2])], known)
                todo += [2 * c, 2 * c + 1]


def counted_columns(columns: int, t: int, p: TreeParams) -> np.ndarray | None:
    """The columns whose histograms tree ``t`` needs: its own, and the first,
    which gives the sums of the root (None: all)."""
    return None if p.forest else np.flatnonzero(_tree_columns(columns, t, p) | (np.arange(columns) == 0))


def values_of(bins: np.ndarray, tree: dict) -> np.ndarray:
    """The value of the leaf of every row in a grown tree."""
    out = np.empty(len(bins))
    for rows, value in Counter(bins.T).leaves(tree):
        out[rows] = value
    return out


def fit_rows(blocks, p: TreeParams, trees: range | None = None) -> tuple[float, list[dict]]:
    """(base, grown trees) over [(block, bins, y)] held in memory; a forest
    may be asked for some of its trees only."""
    blocks = sorted(blocks, key=lambda b: b[0])
    bins, y = np.concatenate([b[1] for b in blocks]), np.concatenate([b[2] for b in blocks])
    base = 0.0 if p.forest else float(y.mean())
    bins = np.ascontiguousarray(bins.T)
    score, grown = np.full(len(y), base), []
    for t in trees if trees is not None else range(p.rounds):
        weight = np.concatenate([row_weights(b, len(x), t, p) for b, x, _ in blocks])
        counter = Counter(bins, p.bins + 1, weight, score - y, counted_columns(len(bins), t, p))
        steps = grow(counter.count(counter.rows[1]), t, p)
        try:
            ask = next(steps)
            while True:
                ask = steps.send(counter.wave(ask))
        except StopIteration as done:
            tree = done.value
        grown.append(tree)
        if not p.forest:
            for rows, value in counter.leaves(tree):
                score[rows] += value
    return base, grown


# --- Spark -------------------------------------------------------------------------

@dataclass
class Frame:
    """Training rows of one fold: features and label."""
    rows: DataFrame
    features: Sequence[str]
    label: str
    edges: dict[int, list[np.ndarray]] = field(default_factory=dict)

    def cut_points(self, bins: int) -> list[np.ndarray]:
        """Quantiles of each feature, in one aggregation."""
        if bins not in self.edges:
            at = [k / bins for k in range(1, bins)]
            cols = [F.percentile_approx(F.when(F.isnan(F.col(c).cast("double")), None).otherwise(F.col(c).cast("double")), at, 100_000).alias(f"_{i}")
                    for i, c in enumerate(self.features)]
            row = self.rows.agg(*cols).first()
            self.edges[bins] = [np.unique(np.array(row[f"_{i}"] or [], np.float64)) for i in range(len(self.features))]
        return self.edges[bins]

    def blocks(self, bins: int, name: int) -> DataFrame:
        """(frame, block, n, bins, y): rows without a label are left out."""
        edges, features, label = self.cut_points(bins), list(self.features), self.label

        def run(batches):
            from pyspark import TaskContext
            serial = TaskContext.get().partitionId() << 32
            for b in batches:
                x = np.column_stack([b.column(c).fill_null(float("nan")).to_numpy(zero_copy_only=False) for c in features])
                y = b.column("_y").to_numpy(zero_copy_only=False).astype(np.float64)
                for i in range(0, len(y), BLOCK_ROWS):
                    part = bin_rows(x[i:i + BLOCK_ROWS], edges)
                    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([serial]), pa.array([len(part)]), pa.array([part.tobytes()]),
                                                      pa.array([y[i:i + BLOCK_ROWS].tobytes()])], ["frame", "block", "n", "bins", "y"])
                    serial += 1

        cols = [F.col(c).cast("double").alias(c) for c in features]
        rows = self.rows.select(*cols, F.col(self.label).cast("double").alias("_y")).where("_y is not null and not isnan(_y)")
        return rows.mapInArrow(run, _BLOCK)


_BLOCK = "frame long, block long, n long, bins binary, y binary"


def _array(row: dict, columns: int):
    return row["block"], np.frombuffer(row["bins"], np.uint8).reshape(-1, columns), np.frombuffer(row["y"], np.float64)


def fit_many(jobs: Sequence[tuple[int, TreeParams]], frames: Sequence[Frame], task_rows: int = TASK_ROWS) -> list[Trees]:
    """The fitted trees of each (frame number, parameters).  ``task_rows``
    only chooses between two ways with one result."""
    spark = frames[0].rows.sparkSession
    ensure_checkpoint_dir(spark)
    grown: list = [None] * len(jobs)
    for bins in sorted({p.bins for _, p in jobs}):
        mine = [i for i, (_, p) in enumerate(jobs) if p.bins == bins]
        table = None
        for f in sorted({jobs[i][0] for i in mine}):
            b = frames[f].blocks(bins, f).checkpoint()        # block numbers are those of the frame alone
            table = b if table is None else table.unionByName(b)
        size = {r["frame"]: r["n"] for r in table.groupBy("frame").agg(F.sum("n").alias("n")).collect()}
        empty = [i for i in mine if not size.get(jobs[i][0])]
        for i in empty:
            grown[i] = (0.0, [])
        inside = [i for i in mine if 0 < size.get(jobs[i][0], 0) <= task_rows]
        beyond = [i for i in mine if size.get(jobs[i][0], 0) > task_rows]
        if inside:
            for i, x in _in_tasks(spark, table, jobs, inside, frames).items():
                grown[i] = x
        for k in range(0, len(beyond), TOGETHER):
            group = beyond[k:k + TOGETHER]
            for i, x in _in_waves(table, jobs, group, frames).items():
                grown[i] = x
    out = []
    for (f, p), (base, trees) in zip(jobs, grown):
        x = assemble(base, trees, frames[f].cut_points(p.bins))
        if p.forest and trees:
            x.value = x.value / len(trees)
        out.append(x)
    return out


def _in_tasks(spark: SparkSession, table: DataFrame, jobs, mine, frames) -> dict:
    """One task a model; a forest is dealt over several by its trees."""
    import json
    plan = []                                  # (unit, job, frame, first tree, end)
    for i in mine:
        f, p = jobs[i]
        step = 25 if p.forest else p.rounds
        plan += [(i, f, a, min(a + step, p.rounds)) for a in range(0, p.rounds, step)]
    units = spark.createDataFrame([(u, f) for u, (_, f, _, _) in enumerate(plan)], "unit long, frame long")
    params = {u: (jobs[i][1], a, b) for u, (i, _, a, b) in enumerate(plan)}
    columns = {f: len(frames[f].features) for f in {jobs[i][0] for i in mine}}

    def fit(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        unit = rows[0]["unit"]
        p, a, b = params[unit]
        base, trees = fit_rows([_array(r, columns[r["frame"]]) for r in rows], p, range(a, b) if p.forest else None)
        said = json.dumps([[[c, *v] for c, v in t.items()] for t in trees])
        return pa.table({"unit": [unit], "base": [base], "trees": [said]})

    wide = table.join(F.broadcast(units), "frame").repartition(min(4 * len(plan), 32 * spark.sparkContext.defaultParallelism), "unit")    # few models share a task
    found = {r["unit"]: r for r in wide.groupBy("unit").applyInArrow(fit, "unit long, base double, trees string").collect()}
    out: dict = {}
    for u, (i, *_) in enumerate(plan):
        trees = [{n[0]: tuple(n[1:]) for n in t} for t in json.loads(found[u]["trees"])]
        base, so_far = out.get(i, (found[u]["base"], []))
        out[i] = (base, so_far + trees)
    return out


def _in_waves(table: DataFrame, jobs, mine, frames) -> dict:
    """Every wave a job over all blocks, of all models together."""
    spark = table.sparkSession
    of_frame = {f: [i for i in mine if jobs[i][0] == f] for f in {jobs[i][0] for i in mine}}
    columns = {f: len(frames[f].features) for f in of_frame}
    params = {i: jobs[i][1] for i in mine}
    table = table.where(F.col("frame").isin(list(of_frame)))
    sums = {r["frame"]: r for r in table.mapInArrow(_label_sums, "frame long, n long, s double").groupBy("frame").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s")).collect()}
    base = {i: 0.0 if params[i].forest else sums[jobs[i][0]]["s"] / sums[jobs[i][0]]["n"] for i in mine}
    grown: dict = {i: [] for i in mine}

    def scored(batches, done, start):
        """Blocks with the predictions of their models, ``done`` trees on."""
        for b in (whole.slice(k, 1) for whole in batches for k in range(whole.num_rows)):     # block by block
            out = []
            for r in b.to_pylist():
                f = r["frame"]
                _, bins, _ = _array(r, columns[f])
                score = np.frombuffer(r["score"], np.float64).reshape(-1, r["n"]).copy() if r["score"] is not None else np.array(
                    [np.full(r["n"], start[i]) for i in of_frame[f]])
                for k, i in enumerate(of_frame[f]):
                    for tree in done[i] if not params[i].forest else []:
                        score[k] += values_of(bins, tree)
                out.append(score.tobytes())
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("frame", "block", "n", "bins", "y")], pa.array(out, pa.binary())],
                                             ["frame", "block", "n", "bins", "y", "score"])

    def advance(df: DataFrame, done) -> DataFrame:
        return df.mapInArrow(lambda it: scored(it, done, base), _BLOCK + ", score binary")

    def counted(df: DataFrame, t: int, asks: dict, grown_so_far: dict, since: int) -> dict:
        """Sums over all blocks of the histograms asked for."""
        recent = {i: grown_so_far[i][since:] for i in asks}

        def run(batches):
            total: dict = {}
            for b in scored(batches, {i: recent.get(i, []) for i in params}, base):
                for r in b.to_pylist():
                    f = r["frame"]
                    block, bins, y = _array(r, columns[f])
                    bins = np.ascontiguousarray(bins.T)
                    score = np.frombuffer(r["score"], np.float64).reshape(-1, r["n"])
                    for k, i in enumerate(of_frame[f]):
                        if i not in asks:
                            continue
                        past, ask = asks[i]
                        p = params[i]
                        c = Counter(bins, p.bins + 1, row_weights(block, len(y), t, p), score[k] - y, counted_columns(len(bins), t, p))
                        for wave in past:
                            c.split(wave)
                        h = np.stack(c.wave(ask)) if ask else c.count(c.rows[1])[None]
                        total[i] = total[i] + h if i in total else h
            if total:
                yield pa.RecordBatch.from_arrays([pa.array(list(total)), pa.array([h.tobytes() for h in total.values()], pa.binary())], ["model", "hist"])

        def add(group: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(x.as_py(), np.float64) for x in group.column("hist"))
            return pa.table({"model": [group.column("model")[0].as_py()], "hist": pa.array([total.tobytes()], pa.binary())})

        sums = df.mapInArrow(run, "model long, hist binary").groupBy("model").applyInArrow(add, "model long, hist binary").collect()
        return {r["model"]: np.frombuffer(r["hist"], np.float64).reshape(-1, columns[jobs[r["model"]][0]], params[r["model"]].bins + 1, 2) for r in sums}

    state = table.withColumn("score", F.lit(None).cast("binary"))
    state, since = advance(state, {i: [] for i in mine}).checkpoint(), 0
    for t in range(max(p.rounds for p in params.values())):
        going = {i for i in mine if t < params[i].rounds}
        first = counted(state, t, {i: ([], []) for i in going}, grown, since)
        steps, asks, past = {i: grow(first[i][0], t, params[i]) for i in going}, {}, {i: [] for i in going}

        def move(i, sent):
            try:
                asks[i] = steps[i].send(sent)
            except StopIteration as done:
                asks.pop(i, None)
                grown[i].append(done.value)

        before = {i: list(grown[i]) for i in mine}
        for i in going:
            move(i, None)
        while asks:
            hist = counted(state, t, {i: (past[i], asks[i]) for i in asks}, before, since)
            for i in list(asks):
                past[i].append(asks[i])
                move(i, list(hist[i]))
        if t + 1 - since >= RENEW:
            state, since = advance(state, {i: grown[i][since:] for i in mine}).checkpoint(), t + 1
    return {i: (base[i], grown[i]) for i in mine}


def _label_sums(batches):
    for b in batches:
        rows = b.to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array([r["frame"] for r in rows], pa.int64()), pa.array([r["n"] for r in rows], pa.int64()),
                                          pa.array([float(np.frombuffer(r["y"], np.float64).sum()) for r in rows], pa.float64())], ["frame", "n", "s"])


# --- learners as the rest of the library uses them ---------------------------------

@dataclass(frozen=True)
class TreeLearner:
    """An estimator over named columns."""
    params: TreeParams
    label: str

    def copy(self, changes: dict) -> "TreeLearner":
        return replace(self, params=replace(self.params, **changes))

    def fit(self, df: DataFrame, features: Sequence[str]) -> "TreeModel":
        return fit_learners([self], df, features)[0]


def fit_learners(learners: Sequence[TreeLearner], df: DataFrame, features: Sequence[str]) -> list["TreeModel"]:
    """All learners on the same rows, side by side."""
    frame = Frame(df, list(features), learners[0].label)
    return [TreeModel(t, list(features)) for t in fit_many([(0, x.params) for x in learners], [frame])]


def all_predictions(models: Sequence["TreeModel"]):
    """The predictions of models over the same features as one array column,
    from Arrow batches of the features."""
    from pyspark.sql.functions import pandas_udf
    trees = [m.trees for m in models]

    @pandas_udf("array<double>")
    def predict(xs):
        import pandas as pd
        x = np.stack(xs.to_numpy()).astype(np.float64) if len(xs) else np.empty((0, 1))
        return pd.Series(list(np.column_stack([t.predict(x) for t in trees])))

    return predict(F.array(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))) for c in models[0].features]))


@dataclass
class TreeModel:
    trees: Trees
    features: list[str]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", all_predictions([self])[0])

    @property
    def featureImportances(self):
        """Share of the total gain per feature (a forest averages its trees)."""
        from pyspark.ml.linalg import Vectors
        total = np.bincount(self.trees.feature[self.trees.feature >= 0], self.trees.gain[self.trees.feature >= 0], len(self.features))
        return Vectors.dense(total / total.sum() if total.sum() else total)

    def to_dict(self) -> dict:
        return {"features": self.features, "trees": self.trees.pack()}

    @staticmethod
    def from_dict(d: dict) -> "TreeModel":
        return TreeModel(Trees.unpack(d["trees"]), list(d["features"]))
