"""Quality score: a generalised additive model with pairwise interactions.

Each feature has a lookup table over its bins, learned by boosting shallow
trees on one feature at a time, in turn, with a small step; then the feature
pairs that explain most of what is left get tables of their own. A score is a
sum of table entries, so scoring is a few vectorised additions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytospark.llm.language import held_out
from cytospark.llm.tables import col, kept
from cytospark.llm.texts import WordHasher, utf8

FEATURES = [
    "log_bytes", "log_words", "word_length", "upper_share", "digit_share", "mark_share", "stop_share", "other_share",
    "line_length", "repeated_lines", "distinct_words", "common_word", "repeated_pairs", "short_words", "long_words",
    "sentence_words", "bracket_share", "white_share",
]

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "mark": b"#$%&*@^~|\\/_=+`", "stop": b".!?",
    "bracket": b"<>{}[]()", "white": b" \t\n\r\x0b\x0c", "line": b"\n",
}
_TABLES = {name: np.isin(np.arange(256), list(members)) for name, members in _CLASSES.items()}
_TABLES["other"] = np.arange(256) >= 128


def _per_row(keys: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of sorted (row << 40 | hash) keys: distinct values and the largest count of each row, repeats."""
    starts = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1])))
    counts = np.diff(np.append(starts, len(keys)))
    row = (keys[starts] >> np.uint64(40)).astype(np.int64)
    most = np.zeros(rows, np.int64)
    np.maximum.at(most, row, counts)
    return np.bincount(row, minlength=rows), most, np.bincount(row, counts * (counts > 1), rows)


def measure(column: pa.Array, hasher: WordHasher) -> np.ndarray:
    """One row of features for each text; all are 0 for null and empty texts."""
    offsets, data = utf8(column)
    out = np.zeros((len(offsets) - 1, len(FEATURES)), np.float32)
    for block in hasher.blocks(column):
        rows = slice(block.first, block.first + block.rows)
        low, high = offsets[block.first], offsets[block.first + block.rows]
        buffer, bounds = data[low:high], offsets[block.first:block.first + block.rows + 1] - low
        share = {}
        for name, members in _TABLES.items():
            sums = np.concatenate(([0], np.cumsum(members[buffer], dtype=np.int64)))
            share[name] = sums[bounds[1:]] - sums[bounds[:-1]]
        size, words = np.diff(bounds), np.diff(block.offsets)
        some, any_word = np.maximum(size, 1), np.maximum(words, 1)
        row = np.repeat(np.arange(block.rows, dtype=np.uint64), words)
        keys = np.sort(row << np.uint64(40) | block.words >> np.uint64(24))
        distinct, most, _ = _per_row(keys, block.rows)
        pair = (block.words[:-1] * np.uint64(3) + block.words[1:])[row[:-1] == row[1:]]
        pair_row = row[:-1][row[:-1] == row[1:]]
        pairs, _, repeats = _per_row(np.sort(pair_row << np.uint64(40) | pair >> np.uint64(24)), block.rows)
        # Lengths of words and of lines, from their ends.
        white = _TABLES["white"][buffer]
        inside = np.concatenate(([0], (~white).view(np.int8), [0]))
        inside_bytes = size - share["white"]
        edge = np.diff(inside)
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        length, of = end - begin, np.minimum(np.searchsorted(bounds, begin, "right") - 1, block.rows - 1)
        lines = share["line"] + 1
        values = {
            "log_bytes": np.log1p(size), "log_words": np.log1p(words), "word_length": inside_bytes / any_word,
            "upper_share": share["upper"] / some, "digit_share": share["digit"] / some,
            "mark_share": share["mark"] / some, "stop_share": share["stop"] / any_word,
            "other_share": share["other"] / some, "line_length": size / lines,
            "repeated_lines": _line_repeats(buffer, bounds), "distinct_words": distinct / any_word,
            "common_word": most / any_word, "repeated_pairs": repeats / np.maximum(pairs, 1),
            "short_words": np.bincount(of, length <= 3, block.rows) / any_word,
            "long_words": np.bincount(of, length > 12, block.rows) / any_word,
            "sentence_words": words / (share["stop"] + 1), "bracket_share": share["bracket"] / some,
            "white_share": share["white"] / some,
        }
        out[rows] = np.where(size[:, None] > 0, np.stack([values[f] for f in FEATURES], axis=1), 0)
    return out


def _line_repeats(buffer: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Share of a text's lines that occur in it before, blank lines aside."""
    share = np.zeros(len(bounds) - 1)
    raw = buffer.tobytes()
    for i, (a, b) in enumerate(zip(bounds.tolist(), bounds[1:].tolist())):
        lines = [x for x in raw[a:b].split(b"\n") if x]
        if len(lines) > 1:
            share[i] = 1 - len(set(lines)) / len(lines)
    return share


def features(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, features) of every row, from its whole text; map-only."""
    source = docs.select(col(doc_id).alias("doc_id"), col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            values = measure(batch.column(1), hasher)
            cells = pa.ListArray.from_arrays(
                np.arange(0, values.size + 1, len(FEATURES), dtype=np.int32), pa.array(values.reshape(-1), pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), cells], names=["doc_id", "features"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, features array<float>")


@dataclass
class AdditiveModel:
    """Bin edges, a table for each feature, and tables for some pairs (over coarser bins)."""

    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def raw(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for i, (edge, values) in enumerate(zip(self.edges, self.tables)):
            total += values[np.searchsorted(edge, x[:, i])]
        for (i, j), values in self.pairs.items():
            total += values[np.searchsorted(self.coarse[i], x[:, i]), np.searchsorted(self.coarse[j], x[:, j])]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw(x)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    cuts = np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))
    return cuts[cuts < values.max()] if len(values) else cuts


def _step(gradient: np.ndarray, hessian: np.ndarray, leaves: int, weight: float) -> np.ndarray:
    """Update of each bin by a tree of at most ``leaves`` leaves on the ordered bins."""
    cuts = [0, len(gradient)]
    g, h = np.concatenate(([0], np.cumsum(gradient))), np.concatenate(([0], np.cumsum(hessian)))
    gain_of = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + weight)
    for _ in range(leaves - 1):
        best, place = 1e-9, None
        for a, b in zip(cuts, cuts[1:]):
            if b - a < 2:
                continue
            m = np.arange(a + 1, b)
            gain = gain_of(a, m) + gain_of(m, b) - gain_of(a, b)
            if gain.max() > best:
                best, place = gain.max(), int(m[gain.argmax()])
        if place is None:
            break
        cuts = sorted({*cuts, place})
    out = np.empty(len(gradient))
    for a, b in zip(cuts, cuts[1:]):
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + weight)
    return out


def _quadrants(gradient: np.ndarray, hessian: np.ndarray, weight: float) -> tuple[float, np.ndarray]:
    """Gain and update of the best pair of cuts, one on each side of a table."""
    n, m = gradient.shape
    if n < 2 or m < 2:
        return 0.0, np.zeros((n, m))
    g, h = gradient.cumsum(0).cumsum(1), hessian.cumsum(0).cumsum(1)
    corner = lambda t: (t[:-1, :-1], t[:-1, -1:] - t[:-1, :-1], t[-1:, :-1] - t[:-1, :-1],
                        t[-1, -1] - t[:-1, -1:] - t[-1:, :-1] + t[:-1, :-1])
    gs, hs = corner(g), corner(h)
    gain = sum(a * a / (b + weight) for a, b in zip(gs, hs)) - g[-1, -1] ** 2 / (h[-1, -1] + weight)
    i, j = np.unravel_index(gain.argmax(), gain.shape)
    values = [a[i, j] / (b[i, j] + weight) for a, b in zip(gs, hs)]
    out = np.empty((n, m))
    out[:i + 1, :j + 1], out[:i + 1, j + 1:], out[i + 1:, :j + 1], out[i + 1:, j + 1:] = values
    return float(gain[i, j]), out


def fit(x: np.ndarray, y: np.ndarray, bins: int = 48, coarse_bins: int = 8, rounds: int = 150, pair_rounds: int = 60,
        n_pairs: int = 10, leaves: int = 3, rate: float = 0.1, weight: float = 5.0) -> AdditiveModel:
    """Cyclic boosting on the logistic loss. One class only, or no rows: a constant model."""
    share = min(max(float(y.mean()) if len(y) else 0.5, 1e-3), 1 - 1e-3)
    model = AdditiveModel(float(np.log(share / (1 - share))), [], [])
    model.edges = [_edges(x[:, i], bins) if len(y) else np.zeros(0) for i in range(x.shape[1])]
    model.coarse = [_edges(x[:, i], coarse_bins) if len(y) else np.zeros(0) for i in range(x.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    if not len(y) or y.min() == y.max():
        return model
    at = [np.searchsorted(e, x[:, i]) for i, e in enumerate(model.edges)]
    raw = np.full(len(y), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-raw))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for i, bin_of in enumerate(at):
            n = len(model.tables[i])
            if n < 2:
                continue
            g, h = slopes()
            update = rate * _step(np.bincount(bin_of, g, n), np.bincount(bin_of, h, n), leaves, weight)
            model.tables[i] += update
            raw += update[bin_of]
    wide = [np.searchsorted(e, x[:, i]) for i, e in enumerate(model.coarse)]

    def histogram(i: int, j: int, values: np.ndarray) -> np.ndarray:
        n, m = len(model.coarse[i]) + 1, len(model.coarse[j]) + 1
        return np.bincount(wide[i] * m + wide[j], values, n * m).reshape(n, m)

    g, h = slopes()
    gains = {(i, j): _quadrants(histogram(i, j, g), histogram(i, j, h), weight)[0]
             for i in range(x.shape[1]) for j in range(i + 1, x.shape[1])}
    for i, j in sorted(gains, key=lambda p: (-gains[p], p))[:n_pairs]:
        model.pairs[i, j] = np.zeros((len(model.coarse[i]) + 1, len(model.coarse[j]) + 1))
    for _ in range(pair_rounds):
        for (i, j), values in model.pairs.items():
            g, h = slopes()
            update = rate * _quadrants(histogram(i, j, g), histogram(i, j, h), weight)[1]
            values += update
            raw += update[wide[i], wide[j]]
    return model


def train(measured: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", fold: int = 5,
          remainder: int = 0, max_rows: int = 40_000, **options) -> AdditiveModel:
    """Fits on labelled rows outside the held-out fold.

    At most about ``max_rows`` of them, chosen by a hash of the id, go to the driver. Several
    labels of one id count as their mean, rounded; null labels and ids do not count.
    """
    marks = labels.where(col(label).isNotNull() & col(doc_id).isNotNull()).groupBy(col(doc_id).alias("doc_id")).agg(
        F.round(F.avg(col(label))).cast("int").alias("y"))
    rows = measured.where(~held_out("doc_id", fold, remainder)).join(marks, "doc_id")
    count = rows.count()
    if count > max_rows:
        share = int(1_000_000 * max_rows / count)
        rows = rows.where(F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1_000_000)) < share)
    sample = rows.select("doc_id", "features", "y").toArrow().sort_by("doc_id")
    x = np.array(sample["features"].to_pylist(), np.float32).reshape(-1, len(FEATURES))
    return fit(x, np.array(sample["y"].to_pylist(), float), **options)


def score(measured: DataFrame, model: AdditiveModel) -> DataFrame:
    """(doc_id, score); map-only."""
    shared = measured.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.score(x), pa.float64())],
                                             names=["doc_id", "score"])

    kind = measured.schema["doc_id"].dataType.simpleString()
    return measured.select("doc_id", "features").mapInArrow(run, f"doc_id {kind}, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **options) -> DataFrame:
    """The rows of ``op9_quality``: doc_id, held_out, score, predicted; one for each row of ``docs``.

    Texts are read once; their features are kept in the shared folder. Null and empty texts
    have all-zero features and the score that the model gives those. A null id is hashed as
    the empty text. Without labels every score is 0.5. Further columns are not read.
    """
    measured = kept(features(docs), "features")
    scored = score(measured, train(measured, labels, **options))
    return scored.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
