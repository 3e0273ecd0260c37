"""Least-squares gradient boosting as MLlib's ``GBTRegressor`` defines it.

The first tree is fitted to the label and counts in full, each later one to twice the residual and counts
``learning_rate``; a leaf is a mean, features are cut into at most ``max_bins`` bins, no split leaves fewer than
``min_child_weight`` rows on a side.

The sums of a table of up to ``ALONE_ROWS`` rows and ``ALONE_BYTES`` are complete in the one task that holds its bins, so that task grows
all trees in one job: a pass per level over held rows costs several times what its sums do.  On larger tables (``TASK_ROWS`` a task)
every level is a job of one stage over the held rows: the driver adds up the tasks' sums (a tree of tasks does beyond ``DRIVER_BYTES``) and picks the splits; running predictions are kept
after every tree, and every ``RESTART_TREES`` trees made anew from the held rows, so that lineage stays short.

Of a node's two children the smaller is summed, the other is the difference; of a feature that mostly has one bin
(an indicator) the other bins are.  The row sample hashes the row's content, not its place.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.models.histtrees import Boosting, HistModel, _mixed
from parcelle.models.treeshap import Tree

MAX_BINS = 32
#: Bits of the code that the bins of several features share; rows that are dealt out together; rows counted at a time.
CODE_BITS, BLOCK_ROWS, CHUNK_ROWS = 10, 4096, 1 << 15
#: A table of at most so many rows and bytes (a byte a feature, some 64 a row besides) is held by one task; otherwise rows of a task.
ALONE_ROWS, ALONE_BYTES, TASK_ROWS = 1 << 21, 384 << 20, 1 << 18
DRIVER_BYTES, RESTART_TREES = 64 << 20, 25


def thresholds(x: DataFrame, d: int, max_bins: int) -> list[np.ndarray]:
    """Cuts of each feature of ``_x``: midpoints of its values if they are at most ``max_bins``, else its quantiles."""
    def values(batches):
        seen = [np.zeros(0) for _ in range(d)]
        for b in batches:
            m = _matrix(b.column(0), d)
            if not np.isfinite(m).all():
                raise ValueError("features must be finite numbers")
            seen = [s if len(s) > max_bins else np.unique(np.append(s, m[:, j])) for j, s in enumerate(seen)]
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([len(s) > max_bins for s in seen]),
                                          pa.array([s[:max_bins + 1] for s in seen], pa.list_(pa.float64()))], names=["j", "many", "v"])

    found = {r["j"]: r for r in x.select("_x").mapInArrow(values, "j int, many boolean, v array<double>").groupBy("j").agg(
        F.max("many").alias("many"), F.array_distinct(F.flatten(F.collect_list("v"))).alias("v")).collect()}  # one row per feature
    cuts = {j: np.unique(r["v"]) for j, r in found.items() if not r["many"] and len(r["v"]) <= max_bins}
    cuts = {j: (v[1:] + v[:-1]) / 2 for j, v in cuts.items()}
    if rest := [j for j in range(d) if j not in cuts]:
        probs = [i / max_bins for i in range(1, max_bins + 1)]
        row = x.agg(*[F.percentile_approx(F.col("_x")[j], probs, 100 * max_bins).alias(f"q{j}") for j in rest]).first()
        cuts |= {j: np.unique(np.array(row[f"q{j}"], dtype=float))[:-1] for j in rest}
    return [cuts[j] for j in range(d)]


BLOCK = "place int, i int, bins binary, y binary, key binary"


def _blocks(rows: list) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names=["place", "i", "bins", "y", "key"])


def _matrix(column, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


class _Rows:
    """The binned rows of one task with their running predictions, and their sums by (node, bin).

    The bins of several features share a code of ``CODE_BITS`` bits, and one count by code serves them all.  Of a feature that
    mostly has one bin only the other rows are held."""

    def __init__(self, bins: np.ndarray, y: np.ndarray, key: np.ndarray, starts: np.ndarray):
        bins = bins.T
        self.y, self.key, self.f = y, key, np.zeros(len(y))
        self.tree, self.at, self.use, self.target = None, None, None, None
        self.n, self.starts, dense, rows, cells = len(y), starts, [], [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
        self.usual, held = {}, 0  # feature: its usual bin, the places of its others
        for j, (a, b) in enumerate(zip(starts[:-1], starts[1:])):
            counts = np.bincount(bins[j], minlength=b - a)
            if counts.max() <= 0.75 * self.n or not self.n:
                dense.append(j)
                continue
            usual = int(counts.argmax())
            other = np.flatnonzero(bins[j] != usual)
            self.usual[j] = (usual, held, held + len(other))
            held += len(other)
            rows.append(other.astype(np.int32))
            cells.append((a + bins[j][other]).astype(np.int32))
        self.rows, self.cells = np.concatenate(rows), np.concatenate(cells)
        self.usual_cells = np.array([starts[j] + usual for j, (usual, _, _) in self.usual.items()], np.int64)
        self.codes, self.packs, self.place = [], [], {}
        for pack, bits in _packs({j: max(1, int(starts[j + 1] - starts[j] - 1).bit_length()) for j in dense}):
            total, code = sum(bits), np.zeros(self.n, np.int64)
            for j, b in zip(pack, bits):
                code = (code << b) | bins[j]
            shifts = total - np.cumsum(bits)
            self.place |= {j: (len(self.codes), int(s), (1 << b) - 1) for j, s, b in zip(pack, shifts, bits)}
            self.codes.append(code.astype(np.uint16 if total <= 16 else np.int64))
            self.packs.append((pack, bits, total))

    def __getstate__(self):
        return self.__dict__ | dict(tree=None, at=None, use=None, target=None)

    def column(self, j: int, rows: np.ndarray) -> np.ndarray:
        """The bins of feature ``j`` in ``rows``."""
        if j in self.place:
            at, shift, mask = self.place[j]
            return (self.codes[at].take(rows) >> shift) & mask
        usual, a, b = self.usual[j]
        whole = np.full(self.n, usual, np.int32)
        whole[self.rows[a:b]] = self.cells[a:b] - self.starts[j]
        return whole.take(rows)

    def walk(self, t: int, nodes) -> dict:
        """The rows of every leaf of tree ``t``; goes on from where the last call for this tree ended."""
        if self.tree != t:
            self.tree, self.at, self.target = t, {0: np.arange(self.n)}, None
        feature, cut, left = nodes
        todo = list(self.at)
        while todo:
            node = todo.pop()
            if feature[node] < 0:
                continue
            rows, below = self.at.pop(node), int(left[node])
            right = self.column(int(feature[node]), rows) > cut[node]
            self.at[below], self.at[below + 1] = rows.take(np.flatnonzero(~right)), rows.take(np.flatnonzero(right))
            todo += [below, below + 1]
        return self.at

    def sums(self, t: int, p: Boosting, nodes, slots: np.ndarray, count: int) -> np.ndarray:
        """Sums of the targets of tree ``t`` and row counts (2 x ``count`` x bins), by the slot (or -1) of the row's node."""
        leaves = sorted(((int(slots[node]), rows) for node, rows in self.walk(t, nodes).items() if slots[node] >= 0), key=lambda v: v[0])
        if self.target is None:
            self.target = 2 * (self.y - self.f) if t else self.y
            self.use = None
            if p.subsample < 1:
                with np.errstate(over="ignore"):
                    self.use = _mixed(self.key ^ _mixed(np.array([p.seed * 1_000_003 + t], np.uint64))) < np.uint64(int(p.subsample * 2**64))
        sel = np.concatenate([rows for _, rows in leaves]) if leaves else np.zeros(0, np.int64)
        k = np.repeat([s for s, _ in leaves], [len(rows) for _, rows in leaves]).astype(np.int64)
        if self.use is not None:
            used = np.flatnonzero(self.use.take(sel))
            sel, k = sel.take(used), k.take(used)
        target, width = self.target.take(sel), int(self.starts[-1])
        g, h = np.zeros((count, width)), np.zeros((count, width))
        if self.usual:
            slot = np.full(self.n, -1, np.int32)
            slot[sel] = k
            at = slot.take(self.rows)
            there = np.flatnonzero(at >= 0)
            cell = at.take(there).astype(np.int64) * width + self.cells.take(there)
            g += np.bincount(cell, self.target.take(self.rows.take(there)), count * width).reshape(count, width)
            h += np.bincount(cell, minlength=count * width).reshape(count, width)
            for into, total in ((g, np.bincount(k, target, count)), (h, np.bincount(k, minlength=count))):
                others = np.add.reduceat(into, self.starts[:-1], 1)  # by feature; its usual bin is empty so far
                into[:, self.usual_cells] = total[:, None] - others[:, list(self.usual)]
        shared = [np.zeros((2, count, 1 << total)) for _, _, total in self.packs]
        for a in range(0, len(sel), CHUNK_ROWS):  # in the order of the slots, so that a chunk meets few of them
            rows, some, low = sel[a:a + CHUNK_ROWS], target[a:a + CHUNK_ROWS], k[a]
            slot = k[a:a + CHUNK_ROWS] - low
            n = int(slot[-1]) + 1
            for codes, (_, _, total), into in zip(self.codes, self.packs, shared):
                cell = (slot << total) + codes.take(rows)
                into[0, low:low + n] += np.bincount(cell, some, n << total).reshape(n, -1)
                into[1, low:low + n] += np.bincount(cell, minlength=n << total).reshape(n, -1)
        for both, (pack, bits, _) in zip(shared, self.packs):
            both = both.reshape(2, count, *(1 << b for b in bits))
            for i, j in enumerate(pack):
                a, b = self.starts[j], self.starts[j + 1]
                g[:, a:b], h[:, a:b] = both.sum(tuple(x for x in range(2, 2 + len(pack)) if x != i + 2))[:, :, :b - a]
        return np.stack([g, h])

    def advanced(self, trees) -> _Rows:
        """These rows after ``trees`` (number, nodes, leaf values)."""
        self.f = self.f.copy()
        for t, nodes, values in trees:
            for node, rows in self.walk(t, nodes).items():
                self.f[rows] += values[node]
            self.tree = None
        return self


def _packs(bits: dict[int, int]):
    """(features, their bits) of codes of ``CODE_BITS`` bits; a feature of more has one of its own."""
    packs = []
    for j in sorted(bits, key=lambda j: (-bits[j], j)):
        for pack in packs:
            if sum(bits[i] for i in pack) + bits[j] <= CODE_BITS:
                pack.append(j)
                break
        else:
            packs.append([j])
    return [(pack, [bits[j] for j in pack]) for pack in packs]


class _Splits:
    """The best split of every node from its sums; of equal ones the first feature, then the first bin."""

    def __init__(self, starts: np.ndarray, min_rows: int):
        sizes = np.diff(starts)
        self.groups = [(np.flatnonzero(sizes == n)[:, None], starts[:-1][sizes == n][:, None] + np.arange(n)) for n in np.unique(sizes) if n > 1]
        place = [((f + 0 * c)[:, :-1].ravel(), (c - c[:, :1])[:, :-1].ravel()) for f, c in self.groups]
        self.feature, self.bin = (np.concatenate([p[i] for p in place]) if place else np.zeros(0, int) for i in (0, 1))
        self.order = np.lexsort((self.bin, self.feature))
        self.feature, self.bin, self.min_rows = self.feature[self.order], self.bin[self.order], max(1, min_rows)

    def __call__(self, g: np.ndarray, h: np.ndarray, total_g: np.ndarray, total_h: np.ndarray):
        """By node: candidate number (-1: none), and the left side's sum and count."""
        n = len(g)
        if not len(self.order):
            return np.full(n, -1), np.zeros(n), np.zeros(n)
        left = [np.concatenate([np.cumsum(v[:, c], 2)[:, :, :-1].reshape(n, -1) for _, c in self.groups], 1)[:, self.order] for v in (g, h)]
        right = [total_g[:, None] - left[0], total_h[:, None] - left[1]]
        ok = (left[1] >= self.min_rows) & (right[1] >= self.min_rows)
        with np.errstate(divide="ignore", invalid="ignore"):
            base = (total_g ** 2 / total_h)[:, None]
            sides = left[0] ** 2 / left[1] + right[0] ** 2 / right[1]
            gain = np.where(ok & (sides > base * (1 + 1e-12)), sides - base, 0.0)
        most = gain.max(1)
        best = np.where(most > 0, (gain >= most[:, None] * (1 - 1e-10)).argmax(1), -1)
        return best, left[0][np.arange(n), best], left[1][np.arange(n), best]


def grow_tree(t: int, p: Boosting, cuts: list, starts: np.ndarray, sums):
    """Tree ``t`` and its walk (number, nodes, leaf values); ``sums(nodes, slots, count)`` are those of all rows."""
    choose, first, rate = _Splits(starts, int(p.min_child_weight)), slice(starts[0], starts[1]), p.learning_rate if t else 1.0
    feature, cut, threshold, left, value = [-1], [0], [0.0], [0], [0.0]

    def nodes():
        return np.array(feature), np.array(cut), np.array(left)

    g, h = sums(nodes(), np.array([0]), 1)
    opened = np.array([0])
    value[0] = rate * g[0, first].sum() / max(h[0, first].sum(), 1)
    for level in range(p.max_depth):
        total_g, total_h = g[:, first].sum(1), h[:, first].sum(1)
        best, left_g, left_h = choose(g, h, total_g, total_h)
        split = np.flatnonzero(best >= 0)
        for i in split:
            at, j, b = opened[i], int(choose.feature[best[i]]), int(choose.bin[best[i]])
            feature[at], cut[at], threshold[at], left[at] = j, b, cuts[j][b], len(feature)
            for sg, sh in ((left_g[i], left_h[i]), (total_g[i] - left_g[i], total_h[i] - left_h[i])):
                for column, v in ((feature, -1), (cut, 0), (threshold, 0.0), (left, 0), (value, rate * sg / sh)):
                    column.append(v)
        if not len(split) or level + 1 == p.max_depth:
            break
        less = left_h[split] * 2 <= total_h[split]
        lefts = np.array(left)[opened[split]]
        slots = np.full(len(feature), -1)
        slots[np.where(less, lefts, lefts + 1)] = np.arange(len(split))
        small = sums(nodes(), slots, len(split))
        large = (g[split] - small[0], h[split] - small[1])
        g, h = (np.stack([np.where(less[:, None], s, b), np.where(less[:, None], b, s)], 1).reshape(2 * len(split), -1) for s, b in zip(small, large))
        opened = np.stack([lefts, lefts + 1], 1).ravel()
    f, _, below = nodes()
    return Tree(f, np.array(threshold), below, np.where(f >= 0, below + 1, 0), np.array(value)), (t, nodes(), np.array(value))


def _grow_over(held, tasks: int, p: Boosting, cuts: list, starts: np.ndarray) -> list[Tree]:
    """The trees on the rows of all elements (``_Rows``) of the RDD ``held``, a job per level."""
    held = held.persist(StorageLevel.MEMORY_AND_DISK)
    state, before, trees, walks = held, None, [], []
    for t in range(p.n_estimators):
        def sums(nodes, slots, count, rows=state, t=t):
            parts = rows.map(lambda r: r.sums(t, p, nodes, slots, count))
            if tasks * 16 * count * int(starts[-1]) > DRIVER_BYTES:
                return parts.treeReduce(lambda a, b: a + b)
            return sum(parts.collect())  # sums of tasks, no rows

        tree, walk = grow_tree(t, p, cuts, starts, sums)
        trees.append(tree)
        walks.append(walk)
        if before not in (None, held):
            before.unpersist()  # the rows it led to are kept since the first level
        before, restart = state, (t + 1) % RESTART_TREES == 0
        state = (held if restart else before).map(lambda r, w=list(walks) if restart else [walk]: r.advanced(w)).persist(StorageLevel.MEMORY_AND_DISK)
    for kept in {state, before, held} - {None}:
        kept.unpersist()
    return trees


def fit_least_squares(df: DataFrame, p, features_col: str, label_col: str, prediction_col: str = "prediction", max_bins: int = MAX_BINS) -> HistModel:
    """One model on all rows of ``df``; empty input, missing labels and features that are no finite numbers raise."""
    rows = df.select(vector_to_array(features_col).alias("_x"), F.col(label_col).cast("double").alias("_y")).withColumn("_key", F.xxhash64("_x", "_y"))
    n, labels, d, d_max = rows.agg(F.count(F.lit(1)), F.count(F.when(F.col("_y").isNotNull() & ~F.isnan("_y"), 1)), F.min(F.size("_x")), F.max(F.size("_x"))).first()
    if not n or labels < n or d != d_max:
        raise ValueError(f"{n} rows, {labels} of them with a label, {d} to {d_max} features")
    cuts = thresholds(rows, d, max_bins)
    starts = np.concatenate([[0], np.cumsum([len(c) + 1 for c in cuts])])
    dtype = np.uint8 if max_bins <= 256 else np.uint16

    def cut(batches):
        place, i = TaskContext.get().partitionId(), 0
        for b in batches:
            x, y, key = _matrix(b.column(0), d), b.column(1).to_numpy(zero_copy_only=False), b.column(2).to_numpy()
            bins = np.stack([np.searchsorted(c, x[:, j], "left").astype(dtype) for j, c in enumerate(cuts)])
            for a in range(0, len(y), BLOCK_ROWS):
                yield _blocks([(place, i, *(m[..., a:a + BLOCK_ROWS].tobytes() for m in (bins, y, key)))])
                i += 1

    def held(blocks):
        """The rows of all blocks, in the order of the table's partitions."""
        parts = sorted((r for b in blocks for r in b.to_pylist()), key=lambda r: (r["place"], r["i"]))
        bins = [np.zeros((d, 0), dtype), *(np.frombuffer(r["bins"], dtype).reshape(d, -1) for r in parts)]
        y, key = (np.concatenate([np.zeros(0, kind), *(np.frombuffer(r[c], kind) for r in parts)]) for c, kind in (("y", float), ("key", np.uint64)))
        return _Rows(np.concatenate(bins, 1).T, y, key, starts)

    def run(blocks):
        rows = held(blocks)
        for t in range(p.n_estimators):
            tree, walk = grow_tree(t, p, cuts, starts, lambda *a: rows.sums(t, p, *a))
            rows.advanced([walk])
            yield pa.RecordBatch.from_arrays([pa.array([t]), pa.array([pickle.dumps(tree)], pa.binary())], names=["t", "tree"])

    def hold(blocks):
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(held(blocks))], pa.binary())], names=["rows"])

    # Cut where the rows lie: what is dealt out is a byte a feature.
    blocks = rows.mapInArrow(cut, BLOCK)
    if n <= min(ALONE_ROWS, ALONE_BYTES // (d + 64)):
        grown = blocks.repartition(1).mapInArrow(run, "t long, tree binary").collect()  # one row per tree
        trees = [pickle.loads(r["tree"]) for r in sorted(grown)]
    else:
        tasks = max(-(-n // TASK_ROWS), df.sparkSession.sparkContext.defaultParallelism)
        parts = blocks.repartition(tasks).mapInArrow(hold, "rows binary").rdd.map(lambda r: pickle.loads(r["rows"]))
        trees = _grow_over(parts, tasks, p, cuts, starts)
    return HistModel(0.0, trees, features_col, prediction_col)
