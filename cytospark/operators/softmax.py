"""Multi-class boosted trees on feature histograms.

Features are cut into bins once. A round grows one tree for each class, all of them level by
level: the gradients of all classes are summed by (node, feature, bin), and the best cut of each node is
chosen from running sums over the bins. ``SparkRows`` does this over a table of any size, one job a level; what reaches
the driver is the best cut of each node. ``LocalRows`` does the same sums in memory, for tables whose binned rows are known to
fit; a grid of models then takes one task a model.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytospark.operators.quantiles import quantiles
from cytospark.session import discard, stored, without_shuffles

# Fixed values of the booster: weight of squared leaves, least hessian of a node, least gain of a cut.
LAMBDA = 1.0
LEAST_HESSIAN = 1.0
LEAST_GAIN = 1e-6
BINS = 256
#: Histogram cells that are held at once.
_CELLS = 1 << 17
#: Bytes of running sums that are kept for the next level of local rows.
_KEPT = 1 << 27
#: Gradients that rounding moves by less are given to all cuts of a node.
_LITTLE = 2.0 ** -8
#: Rows of a node that are summed feature by feature.
_LARGE = 4096
#: Rows that are summed in double precision at once, beyond those of one node.
_EXACT_ROWS = 1 << 20
#: Nodes whose histograms a task holds at once.
_NODES = 64
#: Rounds whose trees are applied anew by each task before the margins are stored again.
_STORE_EVERY = 10


@dataclass
class Tree:
    """Node i holds ``bins <= cut[i]`` of ``feature[i]`` at ``left[i]``, others at ``left[i] + 1``; a leaf has feature -1."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    weight: np.ndarray

    def place(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        node = np.zeros(len(bins), np.int32)
        inner = np.arange(len(bins)) if self.feature[0] >= 0 else np.zeros(0, int)
        while len(inner):
            at = node[inner]
            node[inner] = self.left[at] + (bins[inner, self.feature[at]] > self.cut[at])
            inner = inner[self.feature[node[inner]] >= 0]
        return node


Round = list[Tree]


@dataclass
class SoftmaxTrees:
    """Rounds of trees, one for each class, on binned features."""

    edges: list[np.ndarray]
    rounds: list[Round] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        """Bin of each value: how many edges lie below it."""
        out = np.empty(x.shape, np.uint8)
        for i, edge in enumerate(self.edges):
            out[:, i] = np.searchsorted(edge, x[:, i])
        return out

    def margins(self, bins: np.ndarray, classes: int, since: int = 0) -> np.ndarray:
        out = np.zeros((len(bins), classes))
        for trees in self.rounds[since:]:
            for k, tree in enumerate(trees):
                out[:, k] += tree.weight[0] if tree.feature[0] < 0 else tree.weight[tree.place(bins)]
        return out

    def classes(self) -> int:
        return len(self.rounds[0]) if self.rounds else 1

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Class code of each row; ties go to the first."""
        return self.margins(self.bins(x), self.classes()).argmax(axis=1)

    def table(self) -> pa.Table:
        """A row for each node: round, class, node, feature, threshold, left, weight."""
        rows = [(r, k, i, int(t.feature[i]), float(self.edges[t.feature[i]][t.cut[i]]) if t.feature[i] >= 0 else None,
                 int(t.cut[i]), int(t.left[i]), float(t.weight[i]))
                for r, trees in enumerate(self.rounds) for k, t in enumerate(trees) for i in range(len(t.feature))]
        kinds = [("round", pa.int32()), ("class", pa.int32()), ("node", pa.int32()), ("feature", pa.int32()),
                 ("threshold", pa.float64()), ("cut", pa.int32()), ("left", pa.int32()), ("weight", pa.float64())]
        return pa.table([pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(kinds)], names=[n for n, _ in kinds])

    @classmethod
    def of_table(cls, edges: list[np.ndarray], table: pa.Table) -> SoftmaxTrees:
        table = table.sort_by([("round", "ascending"), ("class", "ascending"), ("node", "ascending")])
        c = {n: table[n].to_numpy() for n in ("round", "class", "feature", "cut", "left", "weight")}
        model = cls(edges)
        starts = np.flatnonzero(table["node"].to_numpy() == 0)
        for a, b in zip(starts, np.append(starts[1:], table.num_rows)):
            if c["round"][a] == len(model.rounds):
                model.rounds.append([])
            model.rounds[-1].append(Tree(c["feature"][a:b], c["cut"][a:b], c["left"][a:b], c["weight"][a:b]))
        return model


def slopes(margins: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of the softmax loss by the margin of each class."""
    p = np.exp(margins - margins.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    h = np.maximum(2 * p * (1 - p), 1e-16)
    p[np.arange(len(y)), y] -= 1
    return p, h


@dataclass
class Cut:
    """A node's best cut and the sums left of it."""

    gain: float
    feature: int
    cut: int
    g: float
    h: float


Node = tuple[int, int]  # class, number in its tree


class Growing:
    """The trees of one round while they grow."""

    def __init__(self, totals: list[tuple[float, float]]):
        self.sums = {(k, 0): total for k, total in enumerate(totals)}
        self.cuts: dict[Node, tuple[Cut, int]] = {}
        self.size = [1] * len(totals)
        self.open = self._splittable([(k, 0) for k in range(len(totals))])

    def _splittable(self, nodes: list[Node]) -> list[Node]:
        return [n for n in nodes if self.sums[n][1] >= 2 * LEAST_HESSIAN]

    def split(self, best: dict[Node, Cut]) -> None:
        """Apply the best cuts of the open nodes; their children are open then."""
        made = []
        for (k, i), cut in sorted(best.items()):
            g, h = self.sums[k, i]
            left = self.size[k]
            self.size[k] += 2
            self.cuts[k, i] = cut, left
            self.sums[k, left], self.sums[k, left + 1] = (cut.g, cut.h), (g - cut.g, h - cut.h)
            made += [(k, left), (k, left + 1)]
        self.open = self._splittable(made)

    def trees(self, rate: float) -> Round:
        out = []
        for k, size in enumerate(self.size):
            feature, cut, left = np.full(size, -1, np.int32), np.zeros(size, np.int32), np.zeros(size, np.int32)
            weight = np.array([-rate * self.sums[k, i][0] / (self.sums[k, i][1] + LAMBDA) for i in range(size)])
            for i in range(size):
                if (k, i) in self.cuts:
                    best, child = self.cuts[k, i]
                    feature[i], cut[i], left[i] = best.feature, best.cut, child
            out.append(Tree(feature, cut, left, weight))
        return out


class Memory:
    """Arrays that are used again and again: new ones of such sizes cost more than the sums in them."""

    def __init__(self):
        self.held: dict[str, np.ndarray] = {}

    def array(self, name: str, shape: tuple[int, ...], kind=float) -> np.ndarray:
        size = math.prod(shape)
        if name not in self.held or len(self.held[name]) < size:
            self.held[name] = np.empty(size, kind)
        return self.held[name][:size].reshape(shape)


class Histograms:
    """Sums of the gradients by (bin, feature, node) of some rows.

    g and h are the parts of one complex number, so that a cell is met once for both; a cell adds up its rows in the
    order of the table. ``columns`` has the bins of each feature.
    """

    def __init__(self, columns: np.ndarray, width: int):
        self.columns, self.width, self.memory = columns.astype(np.intp), width, Memory()

    def blocks(self, node: np.ndarray, slopes: np.ndarray, wanted: Sequence[Node]) -> Iterator[tuple[slice, int, np.ndarray]]:
        """Sums of some of the ``wanted`` nodes and features at a time: nodes, first feature, sums.

        By class come ``node``, the node of each row in its tree, and ``slopes``.
        """
        most = max(1, _CELLS // self.width)
        for low in range(0, len(wanted), most):
            some = wanted[low:low + most]
            count, parts = len(some), []
            for k in sorted({k for k, _ in some}):
                slot = np.full(int(node[k].max(initial=0)) + 1, -1, np.intp)
                for s, (c, i) in enumerate(some):
                    if c == k and i < len(slot):
                        slot[i] = s
                at = slot[node[k]]
                rows = np.flatnonzero(at >= 0)
                parts.append((None, at, slopes[k]) if len(rows) == len(at) else (rows, at[rows], slopes[k][rows]))
            size = max(1, _CELLS // (count * self.width))
            for first in range(0, len(self.columns), size):
                columns = self.columns[first:first + size]
                each = len(columns) * count
                step = each | 1  # sums of one bin; an odd step keeps bins apart in the processor's cache
                cells = self.memory.array("sums", (self.width * step,), complex)
                cells[:] = 0
                for f, column in enumerate(columns):
                    base = column * step + count * f
                    for rows, at, values in parts:
                        np.add.at(cells, at + (base if rows is None else base[rows]), values)
                yield slice(low, low + count), first, cells.reshape(-1, step)[:, :each].reshape(-1, len(columns), count)


class BestCuts:
    """The best cut of each node so far, over blocks of features in their order; ties go to the first feature and bin."""

    def __init__(self, totals: np.ndarray, memory: Memory):
        self.totals, self.memory, nodes = totals, memory, totals.shape[1]
        self.gain, self.feature, self.cut = np.full(nodes, -np.inf), np.zeros(nodes, int), np.zeros(nodes, int)
        self.left = np.zeros(nodes, complex)

    def add(self, nodes: slice, first: int, sums: np.ndarray) -> None:
        """``sums`` by (bin, feature, node); they are made running sums over the bins."""
        if len(sums) < 2:
            return
        for low, high in zip(sums[:-1], sums[1:]):
            low, high = low.reshape(-1).view(float), high.reshape(-1).view(float)
            np.add(high, low, out=high)
        left = sums[:-1]
        gl, hl, hr, gain = (self.memory.array(name, left.shape) for name in ("gl", "hl", "hr", "gain"))
        few = self.memory.array("few", left.shape, bool)
        gl[:], hl[:] = left.real, left.imag
        g, h = self.totals[:, nodes]
        np.subtract(h, hl, out=hr)
        np.less(np.minimum(hl, hr, out=gain), LEAST_HESSIAN, out=few)
        np.multiply(gl, gl, out=gain)
        hl += LAMBDA
        gain /= hl
        gr = np.subtract(g, gl, out=gl)
        gr *= gr
        hr += LAMBDA
        gr /= hr
        gain += gr
        gain -= g ** 2 / (h + LAMBDA)
        np.putmask(gain, few, -np.inf)
        top = gain.max(axis=0)
        feature, top = top.argmax(axis=0), top.max(axis=0)
        better = np.flatnonzero(top > self.gain[nodes])
        feature, at = feature[better], better + nodes.start
        cut = gain[:, feature, better].argmax(axis=0)
        self.gain[at], self.feature[at], self.cut[at] = top[better], feature + first, cut
        self.left[at] = left[cut, feature, better]

    def cuts(self) -> list[Cut | None]:
        parts = self.gain, self.feature, self.cut, self.left.real, self.left.imag
        return [Cut(*c) if c[0] > LEAST_GAIN else None for c in zip(*(p.tolist() for p in parts))]


def _runs(blocks: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Begin and end of runs of equal numbers, ``most`` of them at once."""
    marks = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
    for begin, end in zip(marks, marks[1:]):
        for low in range(begin, end, most):
            yield low, min(low + most, end)


class LocalRows:
    """Binned rows in memory.

    A cut is found in two steps. Sums of rounded gradients bound the gain of each feature: whole numbers, g in the upper and h in the
    lower half of 64 bits, so that only the smaller of two children is summed and the other has what is left of the
    parent's sums. Then the features that can have the best cut are summed in double precision, rows in the order of the
    table and bins in theirs: the first step decides what is summed there, and no bit of a tree.
    """

    def __init__(self, bins: np.ndarray, y: np.ndarray, classes: int):
        self.y, self.columns, features = y, np.ascontiguousarray(bins.T), bins.shape[1]
        self.width = int(bins.max(initial=0)) + 1
        self.together = max(1, _CELLS // max(1, self.width * features))  # nodes summed side by side
        self.step = self.together * features | 1  # sums of one bin; an odd step keeps bins apart in the processor's cache
        self.cells = bins.astype(np.intp) * self.step + np.arange(features)
        self.margins, self.memory, self.exact = np.zeros((len(y), classes)), Memory(), Memory()
        self.spare: list[np.ndarray] = []

    def begin(self) -> list[tuple[float, float]]:
        g, h = slopes(self.margins, self.y)
        self.slopes = np.ascontiguousarray((g + 1j * h).T)
        reach = np.array([np.abs(g).sum(axis=0), h.sum(axis=0)])  # no sum of a class is larger
        scale = np.exp2(np.floor(np.log2((1 << 30) / (reach + 1))))
        wholes = [np.rint(part * by) for part, by in zip((g, h), scale)]
        missed = [whole / by - part for part, whole, by in zip((g, h), wholes, scale)]
        off = np.array([np.maximum(m.clip(0).sum(axis=0), -m.clip(None, 0).sum(axis=0)) for m in missed])
        self.known = np.concatenate([scale, off, reach]).T.tolist()  # by class
        self.wholes = np.ascontiguousarray(((wholes[0].astype("<i8") << 32) + wholes[1].astype("<i8")).T)
        every = np.arange(len(self.y))
        self.rows = {(k, 0): every for k in range(len(self.slopes))}  # of each leaf so far, in the order of the table
        #: By inner node its children and its running sums, if kept.
        self.families = [([(k, 0)], None) for k in range(len(self.slopes))]
        self.kept: dict[Node, np.ndarray] = {}
        return list(zip(g.sum(axis=0).tolist(), h.sum(axis=0).tolist()))

    def best(self, growing: Growing, last: bool = False) -> dict[Node, Cut]:
        """``last`` tells that no level follows, so that no sums are kept."""
        self.spare += self.kept.values()
        self.kept = {}
        if self.width < 2:
            return {}
        most, found = {}, {}
        for n, sums in self._running(set(growing.open), last):
            bounds = self._bounds(n, growing.sums[n], sums)
            if bounds.max() > LEAST_GAIN:
                most[n] = bounds

        def sum_exactly(wanted: list[tuple[Node, int]]) -> None:
            for (n, _), cut in zip(wanted, self._exact(wanted, growing)):
                if cut and (n not in found or (cut.gain, -cut.feature) > (found[n].gain, -found[n].feature)):
                    found[n] = cut

        first = {n: int(bounds.argmax()) for n, bounds in most.items()}
        sum_exactly(list(first.items()))
        least = {n: found[n].gain if n in found else LEAST_GAIN for n in most}
        sum_exactly([(n, f) for n, bounds in most.items() for f in np.flatnonzero(bounds >= least[n]).tolist() if f != first[n]])
        return {n: found[n] for n in growing.open if n in found}

    def _running(self, nodes: set[Node], last: bool) -> Iterator[tuple[Node, np.ndarray]]:
        """Running sums of each node by (bin, feature)."""
        features, todo = len(self.columns), []  # node to sum up, the other child, the parent's sums
        for children, whole in self.families:
            small, *large = sorted(children, key=lambda n: len(self.rows[n]))
            if whole is not None and large[0] in nodes:
                todo.append((small, large[0], whole))
            else:
                todo += [(n, None, None) for n in children if n in nodes]
                self.spare += [] if whole is None else [whole]
        room = 0 if last else _KEPT // (8 * self.width * features)
        for low in range(0, len(todo), self.together):
            some = todo[low:low + self.together]
            cells = self.memory.array("cells", (self.width, self.step), "<i8")
            cells[:] = 0
            for i, (node, *_) in enumerate(some):
                self._add_up(node, cells.reshape(-1)[i * features:])
            for before, after in zip(cells[:-1], cells[1:]):
                np.add(after, before, out=after)
            for i, (node, other, whole) in enumerate(some):
                sums = cells[:, i * features:(i + 1) * features]
                if node in nodes:
                    yield node, sums
                    if len(self.kept) < room:
                        self.kept[node] = self.spare.pop() if self.spare else np.empty(sums.shape, "<i8")
                        self.kept[node][:] = sums
                if other:
                    whole -= sums
                    yield other, whole
                    if len(self.kept) < room:
                        self.kept[other] = whole
                    else:
                        self.spare.append(whole)
        self.families = []

    def _add_up(self, node: Node, cells: np.ndarray) -> None:
        rows, values, features = self.rows[node], self.wholes[node[0]], len(self.columns)
        if len(rows) >= _LARGE:  # a feature's sums stay in the processor's cache
            every = len(rows) == len(self.y)
            values = values if every else values[rows]
            bins, sums = self.memory.array("bins", rows.shape, np.intp), self.memory.array("sums", (self.width,), "<i8")
            for f, column in enumerate(self.columns):
                bins[:] = column if every else column.take(rows)
                sums[:] = 0
                np.add.at(sums, bins, values)
                cells[f::self.step][:self.width] = sums
            return
        step = max(1, _CELLS // features)
        for low in range(0, len(rows), step):
            some = rows[low:low + step]
            np.add.at(cells, self.cells[some].reshape(-1), np.repeat(values[some], features))

    def _bounds(self, node: Node, total: tuple[float, float], sums: np.ndarray) -> np.ndarray:
        """What gain a cut of each feature can have at most.

        With c = h + 2 the gain is (gl - g / c * (hl + 1))^2 * c / ((hl + 1) * (hr + 1)) less a part that all cuts share; a cut with
        enough on both sides has (hl + 1) * (hr + 1) >= 2 * h. Where rounding can have moved little, what a cut at the edge can have
        gained by it is given to all. Elsewhere each cell's square and divisor get their own, as the divisor of a cut in
        the middle grows with the table. The factors are those of the whole numbers, in single precision.
        """
        (g, h), (by_g, by_h, off_g, off_h, reach_g, reach_h), count = total, self.known[node[0]], len(self.rows[node])
        c, ratio = h + 2, g / (h + 2)
        off_g = min(off_g, count / by_g) + 2.0 ** -20 * min(reach_g + 1, count)
        off_h = min(off_h, count / by_h) + 2.0 ** -20 * (min(reach_h + 1, count) + c)
        off, off_both = off_g + abs(ratio) * off_h, off_h * (c + off_h)
        each = off > _LITTLE or off_both > _LITTLE * h
        shape = len(sums) - 1, sums.shape[1]
        a, b, gain = (self.memory.array(name, shape, np.float32) for name in ("a", "b", "gain"))
        half, enough = self.memory.array("half", shape, np.int32), self.memory.array("enough", shape, bool)
        halves = sums[:-1].view("<i4")
        half[:] = halves[:, ::2]
        np.add(half, by_h, out=a, dtype=np.float32, casting="same_kind")
        half[:] = halves[:, 1::2]
        gain[:] = half
        np.multiply(a, ratio * by_g / by_h, out=b)
        gain -= b
        if each:
            np.abs(gain, out=gain)
            gain += off * by_g
        gain *= gain
        np.subtract(c * by_h, a, out=b)
        b *= a
        np.greater_equal(b, (2 * h - 4 * off_both) * by_h * by_h, out=enough)
        if each:
            b -= off_both * by_h * by_h
            np.maximum(b, 2 * h * by_h * by_h, out=b)
        gain /= b
        gain *= enough
        top = gain.max(axis=0).astype(float) * (c * (by_h / by_g) ** 2 * (1 + 2.0 ** -18))
        if not each:
            top = (np.sqrt(top) + 1.1 * off) ** 2 * (1 + off_both / h)
        return top + (1e-12 * (1 + g * g) + g * g / c - g * g / (h + LAMBDA))

    def _exact(self, wanted: list[tuple[Node, int]], growing: Growing) -> Iterator[Cut | None]:
        """The best cut of each node by one feature."""
        most, count = max(1, _CELLS // self.width), len(self.y)
        blocks = np.cumsum([len(self.rows[n]) for n, _ in wanted]) // _EXACT_ROWS
        for low, high in _runs(blocks, most):
            some = wanted[low:high]
            rows = [self.rows[n] for n, _ in some]
            sizes = [len(r) for r in rows]
            rows = np.concatenate(rows)
            bins = self.columns.reshape(-1)[np.repeat([f * count for _, f in some], sizes) + rows]
            at = bins * np.intp(len(some)) + np.repeat(np.arange(len(some)), sizes)
            values = self.slopes.reshape(-1)[np.repeat([n[0] * count for n, _ in some], sizes) + rows]
            cells = np.zeros(self.width * len(some), complex)
            np.add.at(cells, at, values)
            found = BestCuts(np.array([growing.sums[n] for n, _ in some]).T, self.exact)
            found.add(slice(0, len(some)), 0, cells.reshape(self.width, 1, len(some)))
            for (_, f), cut in zip(some, found.cuts()):
                if cut:
                    cut.feature = f
                yield cut

    def advance(self, growing: Growing, best: dict[Node, Cut]) -> None:
        for (k, i), cut in best.items():
            left, rows = growing.cuts[k, i][1], self.rows.pop((k, i))
            right = self.columns[cut.feature][rows] > cut.cut
            self.rows[k, left], self.rows[k, left + 1] = rows[~right], rows[right]
            self.families.append(([(k, left), (k, left + 1)], self.kept.pop((k, i), None)))

    def end(self, trees: Round) -> None:
        for (k, i), rows in self.rows.items():
            self.margins[rows, k] += trees[k].weight[i]


def boost(rows: LocalRows | SparkRows, model: SoftmaxTrees, depth: int, rate: float, rounds: int) -> SoftmaxTrees:
    """Adds ``rounds`` rounds of trees of at most ``depth`` levels."""
    for _ in range(rounds):
        growing = Growing(rows.begin())
        for level in range(depth):
            if not growing.open:
                break
            best = rows.best(growing, level + 1 == depth)
            if not best:
                break
            growing.split(best)
            rows.advance(growing, best)
        trees = growing.trees(rate)
        model.rounds.append(trees)
        rows.end(trees)
    return model


def local_edges(x: np.ndarray, bins: int = BINS) -> list[np.ndarray]:
    """``bin_edges`` of rows in memory."""
    if not len(x):
        return [np.zeros(0)] * x.shape[1]
    marks = np.quantile(x, np.arange(1, bins) / bins, axis=0, method="inverted_cdf")
    return [(e := np.unique(marks[:, i]))[e < x[:, i].max()] for i in range(x.shape[1])]


def train_local(x: np.ndarray, y: np.ndarray, classes: int, depth: int, rate: float, rounds: int) -> SoftmaxTrees:
    return train_local_margins(x, y, classes, depth, rate, rounds)[0]


def train_local_margins(x: np.ndarray, y: np.ndarray, classes: int, depth: int, rate: float, rounds: int) -> tuple[SoftmaxTrees, np.ndarray]:
    """The model and the margins it gives the rows it was trained on."""
    model = SoftmaxTrees(local_edges(x))
    rows = LocalRows(model.bins(x), y, classes)
    return boost(rows, model, depth, rate, rounds), rows.margins


def train_spark(coded: DataFrame, edges: list[np.ndarray], classes: int, depth: int, rate: float, rounds: int) -> SoftmaxTrees:
    rows = SparkRows(coded, edges, classes)
    boost(rows, SoftmaxTrees(edges), depth, rate, rounds)
    return rows.close()


def array_edges(df: DataFrame, column: str, features: int, bins: int = BINS) -> list[np.ndarray]:
    """Up to ``bins - 1`` edges of each element of an array column, at even shares of the rows; features x bins numbers."""
    names = [f"f{i}" for i in range(features)]
    wide = df.select(*[F.col(column)[i].alias(n) for i, n in enumerate(names)])
    at = {r["column"]: r["quantiles"] for r in quantiles(wide, names, [i / bins for i in range(1, bins)], exact=False).collect()}
    most = wide.agg(*[F.max(n).alias(n) for n in names]).first()
    return [(e := np.unique(np.array(at.get(n) or [], float)))[e < (most[n] if most[n] is not None else np.inf)] for n in names]


def values_of(column: pa.Array, features: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), features)


_BLOCK = "bins binary, y binary, margins binary"
_SUMS = "k int, node int, part long, cells binary, slopes binary"
_CUTS = "k int, node int, g double, h double, gain double, feature int, cut int, gl double, hl double"


class SparkRows:
    """Binned rows as stored blocks of a table; a level is one job with one shuffle.

    Each task adds up the histograms of its blocks and sends the cells that have rows; a node's cells meet in one
    group, as many as features x bins from each task, which gives the node's best cut. A level's shuffle is deleted when its
    job ends. ``coded`` has columns ``y``
    (class code) and ``x`` (array of values).
    """

    def __init__(self, coded: DataFrame, edges: list[np.ndarray], classes: int):
        self.spark, self.classes, self.features = without_shuffles(coded.sparkSession), classes, len(edges)
        self.model = SoftmaxTrees(edges)
        self.stored = 0
        model, features = self.model, self.features

        def bin_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bins = model.bins(values_of(batch.column(1), features))
                binary = pa.FixedSizeBinaryArray.from_buffers(pa.binary(features), len(bins), [None, pa.py_buffer(bins.tobytes())])
                yield pa.RecordBatch.from_arrays([batch.column(0), binary.cast(pa.binary())], names=["y", "bins"])

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n = batch.num_rows
                if n:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x], pa.binary()) for x in (b"".join(batch.column(1).to_pylist()), batch.column(0).to_numpy().astype(np.int32).tobytes(),
                                                              np.zeros((n, classes)).tobytes())], names=["bins", "y", "margins"])

        # Bins are dealt out, an eighth of the values, however few files the rows come from.
        rows = coded.select(F.col("y").cast("int"), "x").mapInArrow(bin_rows, "y int, bins binary").repartition(self.spark.sparkContext.defaultParallelism)
        self.blocks, self.blocks_path = stored(rows.mapInArrow(pack, _BLOCK), "binned_blocks", session=self.spark)
        self.roots: dict[Node, Cut] | None = None

    def _blocks(self, work, schema: str, state) -> DataFrame:
        """``work(blocks, state)`` of each task, which gives record batches; blocks are (bins, y, margins)."""
        classes, features = self.classes, self.features
        recent = SoftmaxTrees([], self.model.rounds[self.stored:])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def blocks():
                for batch in batches:
                    for b, y, m in zip(*(batch.column(i) for i in range(3))):
                        bins = np.frombuffer(b.as_py(), np.uint8).reshape(-1, features)
                        margins = np.frombuffer(m.as_py()).reshape(-1, classes) + recent.margins(bins, classes)
                        yield bins, np.frombuffer(y.as_py(), np.int32), margins

            yield from work(blocks(), state)

        return self.blocks.mapInArrow(run, schema)

    def begin(self) -> list[tuple[float, float]]:
        """The sums of the roots; their best cuts come with them."""
        roots = [(k, 0) for k in range(self.classes)]
        found = self._level([Tree(np.array([-1]), np.zeros(1, int), np.zeros(1, int), np.zeros(1))] * self.classes, roots, {})
        self.roots = {n: cut for n, (_, cut) in found.items() if cut}
        return [found[n][0] if n in found else (0.0, 0.0) for n in roots]

    def best(self, growing: Growing, last: bool = False) -> dict[Node, Cut]:
        if self.roots is not None:
            roots, self.roots = self.roots, None
            return {n: c for n, c in roots.items() if n in growing.open}
        found = self._level(growing.trees(0.0), growing.open, {n: growing.sums[n] for n in growing.open})
        return {n: cut for n, (_, cut) in found.items() if cut}

    def _level(self, trees: Round, wanted: list[Node], totals: dict[Node, tuple[float, float]]) -> dict[Node, tuple[tuple[float, float], Cut | None]]:
        """Sums and best cut of each wanted node that has rows. A root's totals are the sums of its bins."""
        features = self.features

        def sums(blocks, state):
            for i, held in enumerate(_task_sums(blocks, *state, features)):
                part = TaskContext.get().partitionId() << 32 | i
                rows = [(*n, part, at.tobytes(), cells[at].tobytes()) for n, cells in held if len(at := np.flatnonzero(cells.imag).astype(np.int32))]
                if rows:
                    kinds = pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["k", "node", "part", "cells", "slopes"])

        def cut(key: tuple, table: pa.Table) -> pa.Table:
            cells = np.zeros(BINS * features, complex)
            for at, values in zip(*(table.sort_by("part")[c] for c in ("cells", "slopes"))):
                cells[np.frombuffer(at.as_py(), np.int32)] += np.frombuffer(values.as_py(), complex)
            cells, node = cells.reshape(BINS, features, 1), tuple(k.as_py() for k in key)
            whole = cells[:, 0, 0].sum()
            g, h = totals.get(node, (whole.real, whole.imag))
            found = BestCuts(np.array([[g], [h]]), Memory())
            found.add(slice(0, 1), 0, cells)
            best = found.cuts()[0]
            row = (*node, g, h, *((best.gain, best.feature, best.cut, best.g, best.h) if best else [None] * 5))
            kinds = [pa.int32()] * 2 + [pa.float64()] * 3 + [pa.int32()] * 2 + [pa.float64()] * 2
            return pa.table([pa.array([v], t) for v, t in zip(row, kinds)], names=[c.split()[0] for c in _CUTS.split(", ")])

        # As many tasks as there is work for; the number of nodes of a level is known here.
        tasks = min(len(wanted), self.spark.sparkContext.defaultParallelism)
        cells = self._blocks(sums, _SUMS, (trees, wanted)).repartition(tasks, "k", "node")
        rows = cells.groupBy("k", "node").applyInArrow(cut, _CUTS).collect()  # a row a node
        return {(r["k"], r["node"]): ((r["g"], r["h"]), Cut(r["gain"], r["feature"], r["cut"], r["gl"], r["hl"]) if r["gain"] is not None else None)
                for r in rows}

    def advance(self, growing: Growing, best: dict[Node, Cut]) -> None:
        """Rows find their nodes from the trees, which the next level's tasks get."""

    def end(self, trees: Round) -> None:
        self.model.rounds.append(trees)
        self.roots = None
        if len(self.model.rounds) - self.stored >= _STORE_EVERY:
            def store(blocks, state):
                for block in blocks:
                    yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in block], names=["bins", "y", "margins"])

            before = self.blocks_path
            self.blocks, self.blocks_path = stored(self._blocks(store, _BLOCK, None), "binned_blocks")
            self.stored = len(self.model.rounds)
            discard(self.spark, before)

    def close(self) -> SoftmaxTrees:
        """The model; the stored blocks go."""
        discard(self.spark, self.blocks_path)
        return self.model


def _task_sums(blocks, trees: Round, wanted: list[Node], features: int) -> Iterator[Iterator[tuple[Node, np.ndarray]]]:
    """Histograms (node, sums by bin and feature) of a task's blocks: of few nodes added up, of many a block and some nodes at a time."""
    together: np.ndarray | None = None
    few = len(wanted) <= _NODES
    for bins, y, margins in blocks:
        g, h = slopes(margins, y)
        node = np.stack([t.place(bins) for t in trees])
        sums, derivatives = Histograms(bins.T, BINS), np.ascontiguousarray((g + 1j * h).T)
        for low in range(0, len(wanted), _NODES):
            some = wanted[low:low + _NODES]
            if together is None or not few:
                together = np.zeros((len(some), BINS, features), complex)
            for nodes, first, found in sums.blocks(node, derivatives, some):
                together[nodes, :, first:first + found.shape[1]] += found.transpose(2, 0, 1)
            if not few:
                yield zip(some, together.reshape(len(some), -1))
    if few and together is not None:
        yield zip(wanted, together.reshape(len(wanted), -1))


def save(model: SoftmaxTrees, spark: SparkSession, path: str) -> None:
    spark.createDataFrame(model.table()).coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")
    edges = [(i, [float(x) for x in e]) for i, e in enumerate(model.edges)]
    spark.createDataFrame(edges, "feature int, edges array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/edges")


def load(spark: SparkSession, path: str) -> SoftmaxTrees:
    edges = sorted(spark.read.parquet(f"{path}/edges").collect())
    return SoftmaxTrees.of_table([np.array(e, float) for _, e in edges], spark.read.parquet(f"{path}/trees").toArrow())
