"""Second-order gradient boosting on histograms, as Spark jobs.

The rows live in the shared folder as blocks: bins of the features, label and prediction so far. A level of a tree is
one pass over the blocks: tasks add up gradients and hessians by (node, feature, bin), only these histograms are
shuffled, and the tasks that receive them find the best split of each (node, feature). The driver sees one row for
each. Of two sibling nodes the one with fewer rows is added up, the other one is its parent less its sibling.

Gradients are added as integers on a scale fixed by label range and row count, so sums do not depend on the order or
the number of tasks: equal rows give an equal model on any partitioning, and a retried task changes nothing.

Trees grow level by level, leaf by leaf (highest gain first), or symmetrically (one split for all nodes of a level).
Rounds are added to the state; with held rows their loss is read off the next pass, so patience costs no job.

A job takes longer than a pass over a million rows. Tables of up to ``ALONE`` values are therefore held by one task, which
grows ``ROUNDS`` rounds of the same trees in one job; larger ones take a job a level, spread over all tasks.
"""

from __future__ import annotations

import json
import math
import sys
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.base import Fitted
from tabloom.operators.stats import quoted
from tabloom.operators.tasks import in_tasks, remove_path, ship_package
from tabloom.session import scratch_path

BLOCK = 8192
#: Rounds after which the predictions in the blocks are brought up to date; newer trees are walked in every pass.
PENDING = 16
LOSS_SCALE = float(1 << 20)
#: Bytes of histograms of a level, over all tasks, that the driver adds up itself instead of asking for a shuffle.
LIGHT = 16 << 20
#: Values (rows by features, label, prediction and gradient) that one task adds up in less time than a job for every level
#: takes, and the rounds it grows before the state is written again.
ALONE = 9_000_000
ROUNDS = 64


@dataclass
class BoostSettings:
    n_estimators: int = 100
    learning_rate: float = 0.1
    max_depth: int = 6
    growth: str = "level"  # level, leaf, symmetric
    num_leaves: int = 31
    max_bins: int = 255
    reg_lambda: float = 1.0
    reg_alpha: float = 0.0
    gamma: float = 0.0
    min_child_weight: float = 1.0
    min_child_samples: int = 1
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    top_rate: float = 0.0  # share of rows with the largest gradients that are always kept ...
    other_rate: float = 0.0  # ... and of all rows drawn from the rest, weighted up
    early_stopping_rounds: int | None = None
    objective: str = "squared"  # squared, logistic
    seed: int = 42


@dataclass
class Tree:
    """Nodes in the order they were made; ``feature`` is -1 for leaves."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    missing_left: list[bool] = field(default_factory=lambda: [True])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, bin_: int, missing_left: bool, gain: float) -> tuple[int, int]:
        left = len(self.feature)
        for name, blank in (("feature", -1), ("bin", 0), ("missing_left", True), ("left", 0), ("right", 0), ("value", 0.0), ("gain", 0.0)):
            getattr(self, name).extend([blank, blank])
        self.feature[node], self.bin[node], self.missing_left[node], self.gain[node] = feature, bin_, missing_left, gain
        self.left[node], self.right[node] = left, left + 1
        return left, left + 1


def common_steps(tree: Tree, front: Sequence[int]) -> list[tuple[int, int, bool]] | None:
    """The cuts below the nodes ``front`` if all nodes of a level have the same one, as in symmetric trees."""
    steps = []
    while any(tree.feature[n] >= 0 for n in front):
        cuts = {(tree.feature[n], tree.bin[n], tree.missing_left[n]) for n in front}
        if len(cuts) > 1:
            return None
        steps += cuts
        front = [c for n in front for c in (tree.left[n], tree.right[n])]
    return steps


def walker(tree: Tree, front: Sequence[int] = (0,)):
    """A function of (bins, node): node of each row; ``bins`` is (features, rows), bin 0 is missing.

    ``node``: where the rows were before the tree grew, in one of the nodes ``front``.
    """
    feature, cut = np.array(tree.feature), np.array(tree.bin)
    missing, left, right = np.array(tree.missing_left), np.array(tree.left), np.array(tree.right)
    steps = common_steps(tree, front)

    def walked(bins: np.ndarray, node: np.ndarray | None = None) -> np.ndarray:
        node = np.zeros(bins.shape[1], np.int64) if node is None else node
        if steps is not None:
            for f, b, missing_left in steps:
                go_right = bins[f] > b
                node = left[node] + (go_right if missing_left else go_right | (bins[f] == 0))
            return node
        rows = np.arange(bins.shape[1])
        while True:
            f = feature[node]
            inner = f >= 0
            if not inner.any():
                return node
            b = bins[np.maximum(f, 0), rows]
            go_left = np.where(b == 0, missing[node], b <= cut[node])
            node = np.where(inner, np.where(go_left, left[node], right[node]), node)

    return walked


def walk(tree: Tree, bins: np.ndarray) -> np.ndarray:
    return walker(tree)(bins)


def draw(rows: np.ndarray, seed: int, round_: int) -> np.ndarray:
    """A number in [0, 1) for each row id, another one each round."""
    x = rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((seed * 1_000_003 + round_) % (1 << 63))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def gradients(y: np.ndarray, f: np.ndarray, objective: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gradient, hessian and loss of each row."""
    if objective == "squared":
        return f - y, np.ones(len(y)), (f - y) ** 2
    p = 1 / (1 + np.exp(-f))
    return p - y, np.maximum(p * (1 - p), 1e-16), np.logaddexp(0, f) - y * f


def gradient_steps(g: np.ndarray, unit: float) -> np.ndarray:
    """Rows by absolute gradient, on a scale of 4097 steps."""
    return np.bincount(np.minimum(np.abs(g) * unit, 4096).astype(np.int64), minlength=4097)


class Sums:
    """A task's histograms of the rows in some nodes, and the loss of its held rows."""

    def __init__(self, tree: Tree, nodes: Mapping[int, int], chosen: Sequence[int], cuts: Sequence[np.ndarray]):
        self.nodes, self.slot_of = nodes, np.full(len(tree.feature), -1, np.int64)
        self.slot_of[np.array(list(nodes), np.int64)] = np.arange(len(nodes))
        self.widths = {f: len(cuts[f]) + 2 for f in chosen}
        self.sums = {f: np.zeros((3, len(nodes) * w), np.int64) for f, w in self.widths.items()}
        self.loss = np.zeros(2, np.int64)

    def add_loss(self, each: np.ndarray) -> None:
        self.loss += [int(np.rint(each * LOSS_SCALE).sum()), len(each)]

    def add(self, bins: np.ndarray, own: np.ndarray, slot: np.ndarray, gi: np.ndarray, hi: np.ndarray | float) -> None:
        """Rows ``own`` of a block, with their slots, scaled gradients and hessians (or the hessian that all have)."""
        for c, width in self.widths.items():
            at, sums = bins[c] if len(own) == bins.shape[1] else bins[c][own], self.sums[c]
            place = slot * width + at if len(self.nodes) > 1 else at
            size = sums.shape[1]
            n = np.bincount(place, minlength=size)
            sums[0] += np.bincount(place, gi, size).astype(np.int64)
            sums[1] += n * int(hi) if np.ndim(hi) == 0 else np.bincount(place, hi, size).astype(np.int64)
            sums[2] += n

    def rows(self) -> list[tuple]:
        """(family, node, feature, hist); node -1 holds the loss."""
        out = [(-1, -1, -1, self.loss.tobytes())] if self.loss[1] else []
        for c, width in self.widths.items():
            by_node = self.sums[c].reshape(3, len(self.nodes), width)
            out += [(p, n, c, by_node[:, i].tobytes()) for i, (n, p) in enumerate(self.nodes.items()) if by_node[2, i].any()]
        return out


def scaled(g: np.ndarray, h: np.ndarray, weight: np.ndarray, scales: tuple[float, float], largest: float) -> tuple[np.ndarray, np.ndarray]:
    """Weighted gradients and hessians as whole numbers."""
    return np.clip(np.rint(g * weight * scales[0]), -largest, largest), np.rint(h * weight * scales[1])


# splits

def shrunk(g, alpha: float):
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0)


def score(g, h, s: BoostSettings):
    return shrunk(g, s.reg_alpha) ** 2 / np.maximum(h + s.reg_lambda, 1e-16)


def leaf_value(g: float, h: float, s: BoostSettings) -> float:
    return float(-s.learning_rate * shrunk(g, s.reg_alpha) / max(h + s.reg_lambda, 1e-16))


def cuts_of(hist: np.ndarray, s: BoostSettings, scales: tuple[float, float]) -> tuple[np.ndarray, np.ndarray]:
    """(gain, left sums) of every cut of one histogram (3, bins): row 0 has missing values left, row 1 right.

    Cut ``b`` sends bins 1 to ``b`` left. Forbidden cuts have gain -inf. Sums are (3, 2, bins - 1): integers.
    """
    total = hist.sum(axis=1)
    below = np.cumsum(hist[:, 1:], axis=1)
    left = np.stack([below + hist[:, :1], below], axis=1)
    right = total[:, None, None] - left
    (gl, hl, nl), (gr, hr, nr) = ((x[0] / scales[0], x[1] / scales[1], x[2]) for x in (left, right))
    gain = 0.5 * (score(gl, hl, s) + score(gr, hr, s) - score(total[0] / scales[0], total[1] / scales[1], s)) - s.gamma
    least = max(1, s.min_child_samples)
    fine = (nl >= least) & (nr >= least) & (hl >= s.min_child_weight) & (hr >= s.min_child_weight)
    gain = np.where(fine, gain, -np.inf)
    if not hist[2, 0]:
        gain[1] = -np.inf  # nothing is missing: both directions are the same
    return gain, left


def best_cut(hist: np.ndarray, s: BoostSettings, scales) -> tuple[float, int, bool, list[int]] | None:
    """(gain, bin, missing left, left sums); ties go to the smaller bin, then to missing values on the left."""
    if hist.shape[1] < 2:
        return None
    gain, left = cuts_of(hist, s, scales)
    at = int(np.argmax(gain.T.ravel()))
    bin_, side = divmod(at, 2)
    found = float(gain[side, bin_])
    return None if found == -np.inf else (found, bin_ + 1, side == 0, [int(v) for v in left[:, side, bin_]])


@dataclass
class Split:
    gain: float
    feature: int
    bin: int
    missing_left: bool
    left: list[int]
    total: list[int]

    @property
    def right(self) -> list[int]:
        return [t - x for t, x in zip(self.total, self.left)]


def merged(rows, wanted: set[int], sibling: Mapping[int, tuple[int, int]]) -> dict[tuple[int, int], np.ndarray]:
    """Histograms by (node, feature): sums of the tasks', and siblings as parent less child.

    ``sibling``: parent -> (the child that was added up, the other one).
    """
    held: dict[tuple[int, int], np.ndarray] = {}
    for node, feature, one in rows:
        if node in wanted:
            held[node, feature] = held[node, feature] + one if (node, feature) in held else one
    for node, feature in [k for k in held if k[0] in sibling]:
        child, other = sibling[node]
        parent = held.pop((node, feature))
        held[other, feature] = parent - held.setdefault((child, feature), np.zeros(len(parent), np.int64))
    return held


def cut_rows(held: Mapping[tuple[int, int], np.ndarray], s: BoostSettings, scales) -> Iterator[tuple]:
    """(node, feature, gain, bin, missing left, left sums, sums) of the best cut of each histogram."""
    for (node, feature), sums in sorted(held.items(), key=lambda x: x[0]):
        if node < 0:
            yield node, feature, None, None, None, None, [int(v) for v in sums]
            continue
        hist = sums.reshape(3, -1)
        cut = None if s.growth == "symmetric" else best_cut(hist, s, scales)
        yield node, feature, *(cut or (None, None, None, None)), [int(v) for v in hist.sum(axis=1)]


def common_cuts(rows, nodes: set[int], s: BoostSettings, scales) -> Iterator[tuple]:
    """(gain, feature, bin, missing left, [[node, left sums]]) of each feature's best cut for all nodes together."""
    gains: dict[int, np.ndarray] = {}
    lefts: dict[int, list] = {}
    for node, feature, sums in sorted(((n, f, h) for n, f, h in rows if n in nodes), key=lambda r: r[:2]):
        gain, left = cuts_of(sums.reshape(3, -1), s, scales)
        if gain.shape[1]:
            gains[feature] = gains.get(feature, 0) + np.where(gain == -np.inf, 0.0, gain)
            lefts.setdefault(feature, []).append((node, left))
    for feature, gain in gains.items():
        bin_, side = divmod(int(np.argmax(gain.T.ravel())), 2)
        own = [[node, *[int(v) for v in left[:, side, bin_]]] for node, left in lefts[feature]]
        yield float(gain[side, bin_]), feature, bin_ + 1, side == 0, own


@dataclass
class Level:
    """Histograms of some nodes: on the driver if they are light, else as a table; and what was found in them."""

    rows: list[tuple]
    held: dict[tuple[int, int], np.ndarray]
    table: DataFrame | None

    def close(self) -> None:
        if self.table is not None:
            self.table.unpersist()


# the state

class Booster:
    """Boosting over rows with numeric features; rounds can be added at any time.

    ``train`` and ``held`` hold the feature columns and the label as doubles; missing values are NULL or NaN.
    """

    def __init__(self, train: DataFrame, features: Sequence[str], label: str, settings: BoostSettings, held: DataFrame | None = None):
        self.s, self.features = settings, list(features)
        self.spark = train.sparkSession
        self.trees: list[Tree] = []
        self.losses: list[float] = []
        self.cuts = self._cut_points(train)
        self.rows, mean, low, high = train.agg(F.count(F.lit(1)), F.avg(quoted(label)), F.min(quoted(label)), F.max(quoted(label))).first()
        mean = mean or 0.0
        if settings.objective == "squared":
            self.base, largest = mean, 2 * max(abs((high or 0) - mean), abs((low or 0) - mean), 1e-30)
        else:
            share = min(max(mean, 1e-6), 1 - 1e-6)
            self.base, largest = math.log(share / (1 - share)), 1.0
        if settings.top_rate:
            largest *= (1 - settings.top_rate) / max(settings.other_rate, 1e-9)
        spare = min(38, 61 - self.rows.bit_length())
        # powers of two: the integers are exact multiples
        self.scales = 2.0 ** (spare - math.ceil(math.log2(largest))), 2.0 ** (spare - (math.ceil(math.log2(max(largest, 1))) if settings.top_rate else 0))
        self.largest = float(1 << (spare + 1))
        self.written: list[str] = []
        self.applied = 0
        self.held_rows = held.count() if held is not None else 0
        parts = self._blocks(train, label, False)
        if held is not None:
            parts = parts.unionByName(self._blocks(held, label, True))
        self._write(parts)

    def _cut_points(self, train: DataFrame) -> list[np.ndarray]:
        steps = [k / self.s.max_bins for k in range(1, self.s.max_bins)]
        asked = [F.percentile_approx(F.when(~F.isnan(quoted(c)), quoted(c)), steps, 20 * self.s.max_bins) for c in self.features]
        return [np.unique(np.array(v if v is not None else [], np.float64)) for v in train.agg(*asked).first()]

    def _blocks(self, df: DataFrame, label: str, held: bool) -> DataFrame:
        """(held, first, n, bins, y, f): blocks of rows, numbered by the task that made them."""
        narrow = df.select(*[quoted(c) for c in self.features], quoted(label).alias("__y"))
        wanted, parts = -(-(self.held_rows if held else self.rows) // (2 * BLOCK)), narrow.rdd.getNumPartitions()
        if parts > wanted:
            narrow = narrow.coalesce(max(1, wanted))
        elif parts < (cores := self.spark.sparkContext.defaultParallelism):
            narrow = narrow.repartition(max(1, min(cores, wanted)))
        cuts, base, wide = self.cuts, self.base, self.s.max_bins > 254

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            first = TaskContext.get().partitionId() << 40 | int(held) << 62
            kept: list[pa.RecordBatch] = []
            size = 0

            def block(table: pa.Table) -> pa.RecordBatch:
                nonlocal first
                n = table.num_rows
                bins = np.zeros((len(cuts), n), np.uint16 if wide else np.uint8)
                for i, c in enumerate(cuts):
                    x = table.column(i).to_numpy().astype(np.float64)
                    bins[i] = np.where(np.isnan(x), 0, 1 + np.searchsorted(c, x, "left"))
                y = table.column(len(cuts)).to_numpy().astype(np.float64)
                columns = [[held], [first], [n], [bins.tobytes()], [y.tobytes()], [np.full(n, base).tobytes()]]
                first += n
                return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _BLOCK_TYPES)], _BLOCK_NAMES)

            for batch in batches:
                kept.append(batch)
                size += batch.num_rows
                while size >= BLOCK:
                    table = pa.Table.from_batches(kept)
                    yield block(table.slice(0, BLOCK))
                    kept, size = table.slice(BLOCK).to_batches(), size - BLOCK
            if size:
                yield block(pa.Table.from_batches(kept))

        return in_tasks(narrow, run, _BLOCKS)

    def _write(self, blocks: DataFrame) -> None:
        """The state, from now on read from the shared folder: lineage ends here."""
        path = scratch_path(self.spark, "boosting")
        blocks.write.parquet(path)
        if self.written:
            self.state.unpersist()
            remove_path(self.spark, self.written[-1])
        self.written.append(path)
        self.state = self.spark.read.schema(_BLOCKS).parquet(path).where("n IS NOT NULL")
        self.tasks = self.state.rdd.getNumPartitions()
        nodes = self.s.num_leaves if self.s.growth == "leaf" else 1 << self.s.max_depth - 1
        self.light = self.tasks * nodes * sum(len(c) + 2 for c in self.cuts) * 24 <= LIGHT

    def close(self) -> None:
        self.state.unpersist()
        remove_path(self.spark, self.written[-1])

    # a pass over the blocks

    def _reader(self, tree: Tree | None):
        """In a task: (held, row ids, bins, y, f up to date, node in the tree being grown) of each block."""
        pending, d, wide = self.trees[self.applied:], len(self.features), self.s.max_bins > 254

        def read(batch: pa.RecordBatch):
            for r in batch.to_pylist():
                bins = np.frombuffer(r["bins"], np.uint16 if wide else np.uint8).reshape(d, r["n"])
                y, f = np.frombuffer(r["y"]), np.frombuffer(r["f"]).copy()
                for t in pending:
                    f += np.array(t.value)[walk(t, bins)]
                node = None if tree is None or r["held"] else walk(tree, bins)
                yield r["held"], r["first"] + np.arange(r["n"]), bins, y, f, node

        return read

    def _refresh(self) -> None:
        read = self._reader(None)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                f = [f.tobytes() for *_, f, _ in read(batch)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(f, pa.binary())], _BLOCK_NAMES)

        self._write(in_tasks(self.state, run, _BLOCKS))
        self.applied = len(self.trees)

    # many rounds in one job

    def _alone(self) -> bool:
        """Whether one task holds all rows and grows the rounds."""
        return self.light and (self.rows + self.held_rows) * (len(self.features) + 3) <= ALONE

    def _grow_alone(self) -> None:
        """Add up to ``ROUNDS`` rounds in one task, none after the patience has run out."""
        read, known = self._reader(None), (self.s, self.features, self.cuts, self.scales, self.largest, self.rows, self.held_rows)
        done, losses = len(self.trees), list(self.losses)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            booster = HeldBooster(known, done, losses, [Block(*x[:5]) for batch in batches for x in read(batch)])
            booster.advance()
            for b in booster.blocks:
                columns = [[b.held], [int(b.rows[0])], [len(b.rows)], [b.bins.tobytes()], [b.y.tobytes()], [b.f.tobytes()], [None]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _MADE_TYPES)], _MADE_NAMES)
            made = json.dumps([[vars(t) for t in booster.trees[done:]], booster.losses])
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip([None] * 6 + [made], _MADE_TYPES)], _MADE_NAMES)

        self._write(in_tasks(self.state.coalesce(1), run, _MADE))
        trees, self.losses = json.loads(self.spark.read.schema("made string").parquet(self.written[-1]).where("made IS NOT NULL").first()[0])
        self.trees += [Tree(**t) for t in trees]
        self.applied = len(self.trees)

    def _weights(self, round_: int, threshold: float | None):
        """In a task: weight of each row in this round, 0 for rows that are not drawn."""
        s = self.s

        def weigh(rows: np.ndarray, g: np.ndarray) -> np.ndarray:
            if threshold is None and s.subsample >= 1:
                return np.ones(len(g))
            lot = draw(rows, s.seed, round_)
            if threshold is not None:
                share = s.other_rate / (1 - s.top_rate)
                return np.where(np.abs(g) >= threshold, 1.0, np.where(lot < share, 1 / share, 0.0))
            return (lot < s.subsample).astype(float)

        return weigh

    def _gradient_threshold(self) -> float | None:
        """The absolute gradient that ``top_rate`` of the rows reach, from counts on a fine scale."""
        s = self.s
        if not s.top_rate:
            return None
        unit = 4096 / (self.largest / self.scales[0])
        left = s.top_rate * self.rows
        for at, n in sorted(self._gradient_counts(unit), reverse=True):
            left -= n
            if left <= 0:
                return at / unit
        return 0.0

    def _gradient_counts(self, unit: float) -> list[tuple[int, int]]:
        """(step, rows) of the absolute gradients."""
        read, s = self._reader(None), self.s

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts = np.zeros(4097, np.int64)
            for batch in batches:
                for held, _, _, y, f, _ in read(batch):
                    if not held:
                        counts += gradient_steps(gradients(y, f, s.objective)[0], unit)
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(counts[at], pa.int64())], ["at", "n"])

        counted = in_tasks(self.state, run, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).collect()
        return [(r["at"], r["n"]) for r in counted]

    def _histograms(self, tree: Tree, nodes: Mapping[int, int], chosen: Sequence[int], round_: int, threshold: float | None) -> DataFrame:
        """(family, node, feature, hist): a task's sums of the rows in some nodes, given with the parent they are dealt by.

        Node -1 holds the loss of the held rows.
        """
        read, weigh, s, scales, cuts = self._reader(tree), self._weights(round_, threshold), self.s, self.scales, self.cuts
        largest = self.largest

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = Sums(tree, nodes, chosen, cuts)
            for batch in batches:
                for held, rows, bins, y, f, node in read(batch):
                    g, h, each = gradients(y, f, s.objective)
                    if held:
                        sums.add_loss(each)
                        continue
                    slot = sums.slot_of[node]
                    weight = weigh(rows, g)
                    own = np.flatnonzero((slot >= 0) & (weight > 0))
                    if len(own):
                        sums.add(bins, own, slot[own], *scaled(g[own], h[own], weight[own], scales, largest))
            if out := sums.rows():
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), _HIST_TYPES)], _HIST_NAMES)

        return in_tasks(self.state, run, _HISTOGRAMS)

    def _splits(self, small: DataFrame, parents: Sequence["Level"], family: Mapping[int, tuple[int, int]]) -> "Level":
        """Sums of the tasks' histograms and the best cut of each (node, feature).

        ``family``: the node that was added up -> (its parent, its sibling).
        """
        s, scales = self.s, self.scales
        sibling = {parent: (child, other) for child, (parent, other) in family.items()}
        wanted = {*family, *sibling} if family else {-1, 0}
        if self.light:
            known = (row for level in parents for row in level.held.items() if row[0][0] in sibling)
            rows = self._gathered(small)
            held = merged([*((n, f, h) for (n, f), h in known), *((n, f, np.frombuffer(h, np.int64)) for n, f, h in rows)], wanted, sibling)
            return Level(list(cut_rows(held, s, scales)), held, None)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = ((n, f, np.frombuffer(h, np.int64)) for b in batches for _, n, f, h in zip(*[c.to_pylist() for c in b.columns]) if n in wanted)
            held = merged(rows, wanted, sibling)
            out = [(n, n, f, held[n, f].tobytes(), *found) for n, f, *found in cut_rows(held, s, scales)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), _SPLIT_TYPES)], _SPLIT_NAMES)

        both = small
        for level in parents:
            both = both.unionByName(level.table.select(*_HIST_NAMES))
        if self.tasks == 1:
            both = both.coalesce(1)
        else:
            both = both.repartition(min(self.tasks, len(self.features)), *(["feature"] if s.growth == "symmetric" else ["family", "feature"]))
        table = in_tasks(both, run, _SPLITS).persist(StorageLevel.MEMORY_AND_DISK)
        rows = [(r["node"], r["feature"], r["gain"], r["bin"], r["missing_left"], r["left"], r["total"]) for r in table.drop("family", "hist").collect()]
        return Level(rows, {}, table)

    def _gathered(self, small: DataFrame) -> list[tuple]:
        """(node, feature, hist) of all tasks."""
        return [(r["node"], r["feature"], r["hist"]) for r in small.collect()]

    # growing

    def _read_splits(self, level: "Level") -> tuple[dict[int, Split], dict[int, list[int]]]:
        """Best split and sums of each node; the loss of the held rows goes on the list."""
        best: dict[int, Split] = {}
        totals: dict[int, list[int]] = {}
        loss = np.zeros(2, np.int64)
        for node, feature, gain, bin_, missing_left, left, total in level.rows:
            if node < 0:
                loss += np.array(total)
                continue
            totals[node] = list(total)
            if gain is None:
                continue
            known = best.get(node)
            if known is None or (gain, -feature) > (known.gain, -known.feature):
                best[node] = Split(gain, feature, bin_, missing_left, list(left), list(total))
        if loss[1]:
            self._note(loss)
        return best, totals

    def _note(self, loss: np.ndarray) -> None:
        if len(self.losses) < len(self.trees):
            self.losses.append(float(loss[0]) / LOSS_SCALE / float(loss[1]))

    def _chosen(self, round_: int) -> list[int]:
        """Features of this round's tree."""
        d = len(self.features)
        keep = max(1, math.ceil(self.s.colsample_bytree * d))
        return sorted(np.argsort(draw(np.arange(d), self.s.seed + 1, round_), kind="stable")[:keep].tolist())

    def grow(self) -> None:
        """Add one round."""
        if len(self.trees) - self.applied >= PENDING:
            self._refresh()
        if not self.state.is_cached:
            self.state.persist(StorageLevel.MEMORY_AND_DISK)
        self._round()

    def _round(self) -> None:
        round_ = len(self.trees)
        chosen, threshold, tree = self._chosen(round_), self._gradient_threshold(), Tree()
        levels = [self._splits(self._histograms(tree, {0: 0}, chosen, round_, threshold), [], {})]
        try:
            if self.s.growth == "symmetric":
                self._symmetric(tree, levels, chosen, round_, threshold)
            else:
                self._grown(tree, levels, chosen, round_, threshold)
        finally:
            for level in levels:
                level.close()
        self.trees.append(tree)

    def _value(self, sums: Sequence[int]) -> float:
        return leaf_value(sums[0] / self.scales[0], sums[1] / self.scales[1], self.s)

    def _descend(self, tree, levels, chosen, round_, threshold, parted: Mapping[int, Split]) -> dict[int, Split]:
        """Best splits of the children of nodes that were just split."""
        family = {}
        for node, split in parted.items():
            children = tree.left[node], tree.right[node]
            if split.left[2] > split.right[2]:
                children = children[::-1]
            family[children[0]] = node, children[1]
        nodes = {child: parent for child, (parent, _) in family.items()}
        small = self._histograms(tree, nodes, chosen, round_, threshold)
        parents = levels if self.s.growth == "leaf" else levels[-1:]  # the parents of a wave may come from several waves
        levels.append(self._splits(small, parents, family))
        return self._read_splits(levels[-1])[0]

    def _grown(self, tree, levels, chosen, round_, threshold) -> None:
        """Level by level, or leaf by leaf: waves look at the children of every leaf that could still be split, and the
        order of splitting is read off their gains, so it takes as many passes as the tree is deep.
        """
        s = self.s
        best, totals = self._read_splits(levels[0])
        full, depth = Tree(), {0: 0}  # with every split the waves have looked at
        full.value[0] = self._value(totals[0]) if totals else 0.0
        leaves = s.num_leaves if s.growth == "leaf" else None
        while True:
            ready = {n: p for n, p in best.items() if full.feature[n] < 0 and p.gain > 0 and depth[n] < s.max_depth}
            if leaves is not None:
                within = self._reachable(full, best, leaves, depth)
                ready = {n: p for n, p in ready.items() if n in within}
            if not ready:
                break
            for node, p in sorted(ready.items()):
                a, b = full.split(node, p.feature, p.bin, p.missing_left, p.gain)
                full.value[a], full.value[b] = self._value(p.left), self._value(p.right)
                depth[a] = depth[b] = depth[node] + 1
            deeper = {n: p for n, p in ready.items() if depth[n] + 1 < s.max_depth}
            if deeper:
                best.update(self._descend(full, levels, chosen, round_, threshold, deeper))
        self._copy(full, self._kept(full, best, leaves), tree)

    @staticmethod
    def _kept(full: Tree, best: Mapping[int, Split], leaves: int | None) -> set[int]:
        """The nodes that are split: all, or the first ``leaves`` - 1 in the order of their gain."""
        inner = {n for n, f in enumerate(full.feature) if f >= 0}
        if leaves is None:
            return inner
        kept: set[int] = set()
        front = [0] if 0 in inner else []
        while front and len(kept) < leaves - 1:
            node = max(front, key=lambda n: (best[n].gain, -n))
            front.remove(node)
            kept.add(node)
            front += [n for n in (full.left[node], full.right[node]) if n in inner]
        return kept

    def _reachable(self, full: Tree, best: Mapping[int, Split], leaves: int, depth) -> set[int]:
        """Leaves that the order of gains may come to, whatever their children turn out to be: the others are looked at later or never."""
        inner = {n for n, f in enumerate(full.feature) if f >= 0}
        can = lambda n: n in best and best[n].gain > 0 and depth[n] < self.s.max_depth
        front, taken, found = [0] if can(0) else [], 0, set()
        while front and taken < leaves - 1:
            node = max(front, key=lambda n: (best[n].gain, -n))
            front.remove(node)
            taken += 1
            if node in inner:
                front += [n for n in (full.left[node], full.right[node]) if can(n)]
            else:
                found.add(node)
        return found

    @staticmethod
    def _copy(full: Tree, kept: set[int], tree: Tree) -> None:
        at = {0: 0}
        tree.value[0] = full.value[0]
        todo = [0]
        while todo:
            node = todo.pop(0)
            if node not in kept:
                continue
            a, b = tree.split(at[node], full.feature[node], full.bin[node], full.missing_left[node], full.gain[node])
            for child, to in ((full.left[node], a), (full.right[node], b)):
                at[child], tree.value[to] = to, full.value[child]
                todo.append(child)

    def _symmetric(self, tree, levels, chosen, round_, threshold) -> None:
        """One split a level: the gains of a cut are added over all nodes of the level."""
        _, totals = self._read_splits(levels[0])
        tree.value[0] = self._value(totals[0]) if totals else 0.0
        leaves = {0: totals[0]} if totals else {}
        for at in range(self.s.max_depth):
            cut = self._common_cut(levels[-1], leaves)
            if cut is None:
                return
            gain, feature, bin_, missing_left, lefts = cut
            parted = {}
            for node in list(leaves):
                total = leaves.pop(node)
                own = lefts.get(node, [0, 0, 0])
                a, b = tree.split(node, feature, bin_, missing_left, gain / max(1, len(lefts)))
                leaves[a], leaves[b] = own, [t - x for t, x in zip(total, own)]
                tree.value[a], tree.value[b] = self._value(leaves[a]), self._value(leaves[b])
                parted[node] = Split(gain, feature, bin_, missing_left, own, total)
            if at + 1 < self.s.max_depth:
                self._descend(tree, levels, chosen, round_, threshold, parted)

    def _common_cut(self, level: "Level", leaves: Mapping[int, list[int]]):
        s, scales, nodes = self.s, self.scales, set(leaves)
        if level.table is None:
            found = list(common_cuts(((n, f, h) for (n, f), h in level.held.items()), nodes, s, scales))
        else:

            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                rows = ((n, f, np.frombuffer(h, np.int64)) for b in batches for n, f, h in zip(*[c.to_pylist() for c in b.columns]))
                out = list(common_cuts(rows, nodes, s, scales))
                if out:
                    types = [pa.float64(), pa.int32(), pa.int32(), pa.bool_(), pa.list_(pa.list_(pa.int64()))]
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)], ["gain", "feature", "bin", "missing_left", "lefts"])

            # the level is dealt by feature already, so all nodes of a feature are in one task
            found = in_tasks(level.table.select("node", "feature", "hist"), run, "gain double, feature int, bin int, missing_left boolean, lefts array<array<bigint>>").collect()
        found = [r for r in found if r[0] > 0]
        if not found:
            return None
        gain, feature, bin_, missing_left, lefts = max(found, key=lambda r: (r[0], -r[1]))
        return gain, feature, bin_, missing_left, {x[0]: list(x[1:]) for x in lefts}

    def _read_loss(self) -> None:
        """The loss after the last round, which no later pass has noted yet."""
        if self.held_rows and len(self.losses) < len(self.trees):
            level = self._splits(self._histograms(Tree(), {}, [], 0, None), [], {})
            self._read_splits(level)
            level.close()

    def fit(self, on_round=None) -> "BoostedModel":
        """Rounds until there are enough, or until ``early_stopping_rounds`` of them have not lowered the held loss."""
        stopped = False
        alone = self._alone() and not on_round  # who asks after every round gets them one by one
        while self.rows and len(self.trees) < self.s.n_estimators and not stopped:
            if alone:
                self._grow_alone()
            else:
                self.grow()
            if on_round:
                on_round(self)
            stopped = self._out_of_patience()
        if not stopped:
            self._read_loss()
        best = int(np.argmin(self.losses)) + 1 if self._patience() and self.losses else len(self.trees)
        return self.model(best)

    def _patience(self) -> int | None:
        return self.s.early_stopping_rounds if self.held_rows else None

    def _out_of_patience(self) -> bool:
        patience = self._patience()
        return bool(patience and self.losses) and len(self.losses) - 1 - int(np.argmin(self.losses)) >= patience

    def model(self, rounds: int | None = None) -> "BoostedModel":
        trees = self.trees if rounds is None else self.trees[:rounds]
        return BoostedModel(
            features=self.features, base=self.base, objective=self.s.objective, losses=self.losses,
            trees=[[t.feature, [float(self.cuts[f][b - 1]) if f >= 0 and b <= len(self.cuts[f]) else sys.float_info.max for f, b in zip(t.feature, t.bin)], t.missing_left, t.left, t.right, t.value, t.gain] for t in trees],
        )


class Block:
    """Rows in the memory of a task: the state, and what holds during a round."""

    __slots__ = ("held", "rows", "bins", "places", "y", "f", "g", "h", "own", "gi", "hi", "node")

    def __init__(self, held: bool, rows: np.ndarray, bins: np.ndarray, y: np.ndarray, f: np.ndarray):
        self.held, self.rows, self.bins, self.y, self.f = held, rows, bins, y, f
        self.places = None if held else bins.astype(np.int64)


class HeldBooster(Booster):
    """The rounds inside a task that holds all rows; what it decides, and from which sums, is as in the jobs."""

    def __init__(self, known: tuple, done: int, losses: Sequence[float], blocks: list[Block]):
        self.s, self.features, self.cuts, self.scales, self.largest, self.rows, self.held_rows = known
        self.trees, self.losses, self.blocks, self.light = [Tree()] * done, list(losses), blocks, True
        self.same_hessian = self.s.objective == "squared" and not self.s.top_rate

    def advance(self) -> None:
        most = min(self.s.n_estimators, len(self.trees) + ROUNDS)
        while True:
            for b in self.blocks:
                if not b.held:
                    b.g, b.h, _ = gradients(b.y, b.f, self.s.objective)
                    b.gi = None
            self.walked = None
            self._round()
            self._walk(self.trees[-1])
            values = np.array(self.trees[-1].value)
            for b in self.blocks:
                b.f += values[b.node]
            if len(self.trees) >= most or self._out_of_patience():
                return

    def _walk(self, tree: Tree) -> None:
        """The node of every row, from where it was if the tree is the one walked last."""
        known = tree is self.walked
        go = walker(tree, self.front) if known else walker(tree)
        for b in self.blocks:
            b.node = go(b.bins, b.node if known else None)
        self.walked, self.front = tree, [n for n, f in enumerate(tree.feature) if f < 0]

    def _gathered(self, small: list[tuple]) -> list[tuple]:
        return [(n, f, h) for _, n, f, h in small]

    def _gradient_counts(self, unit: float) -> list[tuple[int, int]]:
        counts = sum((gradient_steps(b.g, unit) for b in self.blocks if not b.held), np.zeros(4097, np.int64))
        return [(int(at), int(counts[at])) for at in np.flatnonzero(counts)]

    def _histograms(self, tree: Tree, nodes: Mapping[int, int], chosen: Sequence[int], round_: int, threshold: float | None) -> list[tuple]:
        sums, weigh = Sums(tree, nodes, chosen, self.cuts), self._weights(round_, threshold)
        same = np.rint(self.scales[1])
        self._walk(tree)
        for b in self.blocks:
            if b.held:
                if len(self.losses) < len(self.trees):
                    sums.add_loss(gradients(b.y, b.f, self.s.objective)[2])
                continue
            if b.gi is None:
                weight = weigh(b.rows, b.g)
                b.own = None if (weight > 0).all() else weight > 0
                b.gi, b.hi = scaled(b.g, b.h, weight, self.scales, self.largest)
            slot = sums.slot_of[b.node]
            own = np.flatnonzero(slot >= 0 if b.own is None else (slot >= 0) & b.own)
            if len(own):
                sums.add(b.places, own, slot[own], b.gi[own], same if self.same_hessian else b.hi[own])
        return sums.rows()


_BLOCKS = "held boolean, first bigint, n int, bins binary, y binary, f binary"
_BLOCK_NAMES = [x.split()[0] for x in _BLOCKS.split(", ")]
_BLOCK_TYPES = [pa.bool_(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
_MADE = f"{_BLOCKS}, made string"
_MADE_NAMES, _MADE_TYPES = [*_BLOCK_NAMES, "made"], [*_BLOCK_TYPES, pa.string()]
_HISTOGRAMS = "family int, node int, feature int, hist binary"
_HIST_NAMES = [x.split()[0] for x in _HISTOGRAMS.split(", ")]
_HIST_TYPES = [pa.int32(), pa.int32(), pa.int32(), pa.binary()]
_SPLITS = "family int, node int, feature int, hist binary, gain double, bin int, missing_left boolean, left array<bigint>, total array<bigint>"
_SPLIT_NAMES = [x.split()[0] for x in _SPLITS.split(", ")]
_SPLIT_TYPES = [*_HIST_TYPES, pa.float64(), pa.int32(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.int64())]


def margins(state: Mapping, columns: Sequence[np.ndarray]) -> np.ndarray:
    """Sum of the base and all trees; NaN is missing."""
    n = len(columns[0]) if columns else 0
    x = np.vstack(columns) if columns else np.zeros((0, n))
    total, rows = np.full(n, float(state["base"])), np.arange(n)
    for feature, cut, missing, left, right, value, _ in state["trees"]:
        steps = common_steps(Tree(feature, cut, missing, left, right), (0,))
        feature, cut, missing, left, right = map(np.array, (feature, cut, missing, left, right))
        node = np.zeros(n, np.int64)
        for f, c, missing_left in steps or ():
            node = left[node] + (x[f] > c if missing_left else ~(x[f] <= c))  # NaN is neither
        while steps is None:
            f = feature[node]
            inner = f >= 0
            if not inner.any():
                break
            v = x[np.maximum(f, 0), rows]
            go = np.where(np.isnan(v), missing[node], v <= cut[node])
            node = np.where(inner, np.where(go, left[node], right[node]), node)
        total += np.array(value)[node]
    return total


class Weights(list):
    def toArray(self) -> np.ndarray:
        return np.array(self)


class BoostedModel(Fitted):
    """Appends ``__prediction`` (and ``__probability`` for classes) under its own column names; lazy, one Arrow pass."""

    @property
    def getNumTrees(self) -> int:
        return len(self.fitted["trees"])

    @property
    def featureImportances(self) -> Weights:
        """Gains by feature, adding up to 1."""
        found = np.zeros(len(self.fitted["features"]))
        for feature, *_, gain in self.fitted["trees"]:
            for f, g in zip(feature, gain):
                if f >= 0:
                    found[f] += g
        return Weights((found / found.sum() if found.sum() > 0 else found).tolist())

    def _names(self) -> tuple[str, str]:
        suffix = self.fitted.get("suffix", "")
        return f"__prediction{suffix}", f"__probability{suffix}"

    def named(self, suffix: str) -> "BoostedModel":
        return BoostedModel(**{**self.fitted, "suffix": suffix})

    def _transform(self, df: DataFrame) -> DataFrame:
        spark = df.sparkSession
        ship_package(spark)
        state = spark.sparkContext.broadcast(self.fitted)

        @F.arrow_udf("double")
        def margin(*columns: pa.Array) -> pa.Array:
            return pa.array(margins(state.value, [c.to_numpy(zero_copy_only=False).astype(np.float64) for c in columns]))

        names = self.fitted["features"]
        prediction, probability = self._names()
        scored = df.withColumn("__margin", margin(*[quoted(c).cast("double") for c in names]))
        if self.fitted["objective"] == "squared":
            return scored.withColumnRenamed("__margin", prediction)
        p = 1 / (1 + F.exp(-F.col("__margin")))
        return scored.withColumn(probability, F.array(1 - p, p)).withColumn(prediction, (p > 0.5).cast("double")).drop("__margin")
