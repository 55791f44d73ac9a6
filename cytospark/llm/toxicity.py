"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence has a logistic score of its own words; the
document is toxic unless every sentence is harmless: 1 - prod(1 - p), a noisy-or. Only labels of
documents are needed to train the weights, and the same weights then say which sentences offend.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytospark.llm.language import held_out
from cytospark.llm.tables import col, kept
from cytospark.llm.texts import LOWER, SLICE_BYTES, Powers, mix, utf8

#: Bytes that make words: ASCII letters and digits, and all of other letters.
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
#: Bytes that end a sentence.
_STOP = np.isin(np.arange(256), list(b".!?\n"))
#: Lengths, in bytes, of the beginnings of a word that are features beside the word.
PREFIXES = (3, 4, 5, 6, 7, 8, 10, 12)
_BASE = 0xC2B2AE3D27D4EB4F
_VALUES = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)
_WHOLE, _PAIR = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


@dataclass
class Sentences:
    """The sentences with a word in some consecutive texts, and their features."""

    first: int              # row of the batch
    row: np.ndarray         # text of each sentence, from 0 in this slice
    rows: int
    begin: np.ndarray       # byte range of each sentence in its slice
    end: np.ndarray
    bounds: np.ndarray      # byte range of each text
    grams: np.ndarray       # uint64 features
    of: np.ndarray          # sentence of each feature


class Reader:
    """Cuts texts into sentences and hashes words, their beginnings and neighbouring pairs."""

    def __init__(self, slice_bytes: int = SLICE_BYTES):
        self.slice_bytes, self.powers = slice_bytes, Powers(_BASE)

    def slices(self, column: pa.Array) -> Iterator[Sentences]:
        offsets, data = utf8(column)
        n, low = len(offsets) - 1, 0
        while low < n:
            high = int(np.searchsorted(offsets, offsets[low] + self.slice_bytes, "right")) - 1
            high = min(max(high, low + 1), n)
            yield self._slice(low, offsets[low:high + 1] - offsets[low], data[offsets[low]:offsets[high]])
            low = high

    def _slice(self, first: int, bounds: np.ndarray, raw: np.ndarray) -> Sentences:
        buffer = LOWER[raw]
        cuts = np.unique(np.concatenate((bounds, np.flatnonzero(_STOP[buffer]) + 1)))
        inside = np.concatenate(([False], _WORD[buffer], [False]))
        change = inside[1:] != inside[:-1]
        change[cuts] |= inside[1:][cuts] & inside[:-1][cuts]  # a word ends with its text
        # Of each boundary: does a word begin or end here? One may do both where texts meet.
        starts = np.flatnonzero(change & inside[1:])
        stops = np.flatnonzero(change & inside[:-1])
        sentence = np.searchsorted(cuts, starts, "right") - 1
        new = np.ones(len(sentence), bool)
        new[1:] = sentence[1:] != sentence[:-1]
        used, of_word = sentence[new], np.cumsum(new) - 1
        begin, end = cuts[used], cuts[np.minimum(used + 1, len(cuts) - 1)]
        row = np.searchsorted(bounds, begin, "right") - 1
        grams, of = self._grams(buffer, starts, stops, of_word)
        return Sentences(first, row, len(bounds) - 1, begin, end, bounds, grams, of)

    def _grams(self, buffer: np.ndarray, starts: np.ndarray, stops: np.ndarray, of_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        up, down = self.powers.to(max(len(buffer), 1))
        sums = np.zeros(len(buffer) + 1, np.uint64)
        np.cumsum(_VALUES[buffer] * up[:len(buffer)], out=sums[1:])
        size = stops - starts

        def run(which: np.ndarray, length: np.ndarray | int) -> np.ndarray:
            a = starts[which]
            return mix((sums[a + length] - sums[a]) * down[a] + np.uint64(1) * np.asarray(length, np.uint64))

        every = np.arange(len(starts))
        whole = run(every, size)
        grams, of = [whole ^ _WHOLE], [of_word]
        for length in PREFIXES:
            longer = np.flatnonzero(size > length)
            grams.append(run(longer, length))
            of.append(of_word[longer])
        same = np.flatnonzero(of_word[1:] == of_word[:-1])
        grams.append(mix(whole[same] * np.uint64(3) + whole[same + 1]) ^ _PAIR)
        of.append(of_word[same])
        return np.concatenate(grams), np.concatenate(of)


@dataclass
class BagModel:
    """Weights of chosen features; a sentence's score is logistic in the sum of those it holds."""

    grams: np.ndarray       # sorted
    weights: np.ndarray
    bias: float

    def __post_init__(self) -> None:
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(self.grams >> np.uint64(44)).astype(np.int64)] = True

    def known(self, part: Sentences) -> tuple[np.ndarray, np.ndarray]:
        """(sentence, feature number) of the features that the model has, each once a sentence."""
        maybe = np.flatnonzero(self.seen[(part.grams >> np.uint64(44)).astype(np.int64)])
        grams = part.grams[maybe]
        at = np.searchsorted(self.grams, grams)
        at[at == len(self.grams)] = 0
        hit = self.grams[at] == grams if len(self.grams) else np.zeros(len(at), bool)
        pairs = np.unique(part.of[maybe[hit]] * np.int64(len(self.grams) + 1) + at[hit])
        return pairs // (len(self.grams) + 1), pairs % (len(self.grams) + 1)

    def harm(self, part: Sentences) -> np.ndarray:
        """-log(1 - p) of each sentence: these add up over a document."""
        of, at = self.known(part)
        return np.logaddexp(0, self.bias + np.bincount(of, self.weights[at], len(part.row)))

    def score(self, column: pa.Array, reader: Reader) -> np.ndarray:
        """Noisy-or of each text; 0 without a sentence."""
        out = np.zeros(len(column))
        for part in reader.slices(column):
            out[part.first:part.first + part.rows] = -np.expm1(-np.bincount(part.row, self.harm(part), part.rows))
        return out


def fit(bag: np.ndarray, plain: np.ndarray, sentence: np.ndarray, gram: np.ndarray, toxic: np.ndarray, grams: np.ndarray,
        turns: int = 400, rate: float = 0.1, weight: float = 5e-4) -> BagModel:
    """Weights that make the noisy-or likely, by gradient steps with momentum and adapted rates.

    ``bag``: the document of each sentence with features; ``sentence``, ``gram``: the (sentence, feature) pairs;
    ``plain``: how many further sentences each document has; ``toxic``: its label. One class only, or
    no documents: no weights, and the share of toxic documents as the score of one sentence.
    """
    share = min(max(float(toxic.mean()) if len(toxic) else 0.5, 1e-4), 1 - 1e-4)
    if not len(toxic) or toxic.min() == toxic.max():
        return BagModel(grams, np.zeros(len(grams)), float(np.log(share / (1 - share))))
    theta = np.zeros(len(grams) + 1)  # the last is the bias
    theta[-1] = -6.0
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for turn in range(1, turns + 1):
        z = theta[-1] + np.bincount(sentence, theta[gram], len(bag))
        harm = np.bincount(bag, np.logaddexp(0, z), len(toxic)) + plain * np.logaddexp(0, theta[-1])
        harmless = np.exp(-harm)
        # Slope of the loss by a document's harm: 1 if not toxic, -harmless / (1 - harmless) if toxic.
        slope = np.where(toxic > 0, -harmless / np.maximum(1 - harmless, 1e-12), 1.0) / len(toxic)
        each = slope[bag] / (1 + np.exp(-z))
        step = np.append(np.bincount(gram, each[sentence], len(grams)) + weight * theta[:-1] / 10,
                         each.sum() + (slope * plain).sum() / (1 + np.exp(-theta[-1])))
        first = 0.9 * first + 0.1 * step
        second = 0.99 * second + 0.01 * step ** 2
        theta -= rate * (first / (1 - 0.9 ** turn)) / (np.sqrt(second / (1 - 0.99 ** turn)) + 1e-9)
        theta[:-1] = np.sign(theta[:-1]) * np.maximum(np.abs(theta[:-1]) - rate * weight, 0)
    return BagModel(grams, theta[:-1], float(theta[-1]))


def labelled(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text", fold: int = 5,
             remainder: int = 0, max_rows: int = 20_000) -> DataFrame:
    """(doc_id, text, y) of about ``max_rows`` labelled rows at most, chosen by a hash of the id, outside the held-out fold.

    Several labels of one id count as their mean, rounded; null labels and ids do not count.
    """
    marks = labels.where(col(label).isNotNull() & col(doc_id).isNotNull()).groupBy(col(doc_id).alias("doc_id")).agg(
        F.round(F.avg(col(label))).cast("int").alias("y")).where(~held_out("doc_id", fold, remainder))
    count = marks.count()
    if count > max_rows:
        share = int(1_000_000 * max_rows / count)
        marks = marks.where(F.pmod(F.xxhash64(F.lit("bags"), "doc_id"), F.lit(1_000_000)) < share)
    return docs.select(col(doc_id).alias("doc_id"), col(text).alias("text")).join(marks, "doc_id")


def telling_grams(sample: DataFrame, most: int = 8192, least: int = 3, evidence: float = 6.0) -> np.ndarray:
    """The features that tell toxic documents from others best, by the likelihood ratio of their document counts.

    Those in fewer than ``least`` documents, or with less ``evidence`` (a natural logarithm), do not count; at
    most ``most`` reach the driver.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches:
            y = batch.column(1).to_numpy()
            for part in reader.slices(batch.column(0)):
                g, r = part.grams, part.row[part.of]
                order = np.lexsort((r, g))
                g, r = g[order], r[order]
                new = np.ones(len(g), bool)
                new[1:] = (g[1:] != g[:-1]) | (r[1:] != r[:-1])
                g, toxic = g[new], y[part.first + r[new]]
                start = np.flatnonzero(np.concatenate((np.ones(min(1, len(g)), bool), g[1:] != g[:-1])))
                total = np.diff(np.append(start, len(g)))
                bad = np.add.reduceat(toxic, start) if len(start) else np.zeros(0, int)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(g[start].view(np.int64)), pa.array(bad, pa.int64()), pa.array(total - bad, pa.int64())], names=["gram", "bad", "good"])

    counts = sample.groupBy("y").count().collect()
    n = {r["y"]: r["count"] for r in counts}
    bad_all, good_all = max(n.get(1, 0), 1), max(n.get(0, 0), 1)
    sums = sample.select("text", "y").mapInArrow(run, "gram bigint, bad bigint, good bigint").groupBy("gram").agg(
        F.sum("bad").alias("bad"), F.sum("good").alias("good")).where(F.col("bad") + F.col("good") >= least)
    expected = (F.col("bad") + F.col("good")) / (bad_all + good_all)
    part = lambda seen, share: F.when(seen > 0, seen * F.log(seen / share)).otherwise(0.0)
    ratio = part(F.col("bad"), expected * bad_all) + part(F.col("good"), expected * good_all)
    best = sums.select("gram", ratio.alias("ratio")).where(F.col("ratio") >= evidence).orderBy(F.desc("ratio"), "gram").limit(most)
    return np.sort(best.select("gram").toArrow()["gram"].to_numpy().view(np.uint64))


def train(sample: DataFrame, **options) -> BagModel:
    """Chooses features and fits their weights; the driver sees feature numbers of the sample's sentences, no texts."""
    grams = telling_grams(sample)
    shared = sample.sparkSession.sparkContext.broadcast(BagModel(grams, np.zeros(len(grams)), 0.0))  # at most 8192 features

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches:
            for part in reader.slices(batch.column(2)):
                of, at = shared.value.known(part)
                holds = np.unique(of)
                row, number = part.row[of], np.searchsorted(holds, of)
                first = np.searchsorted(part.row[holds], np.arange(part.rows))
                bags = np.searchsorted(row, np.arange(part.rows + 1))
                sentences = np.bincount(part.row, minlength=part.rows)
                told = np.bincount(part.row[holds], minlength=part.rows)
                rows = batch.slice(part.first, part.rows)
                kind = lambda x: pa.ListArray.from_arrays(pa.array(bags, pa.int32()), pa.array(x, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(sentences - told, pa.int64()), kind(number - first[row]), kind(at)],
                    names=["doc_id", "y", "plain", "sentence", "gram"])

    bags = sample.select("doc_id", "y", "text").mapInArrow(
        run, f"doc_id {sample.schema['doc_id'].dataType.simpleString()}, y int, plain bigint, sentence array<int>, gram array<int>")
    table = bags.toArrow().sort_by("doc_id")
    y, plain = table["y"].to_numpy().astype(float), table["plain"].to_numpy().astype(float)
    lists, gram = table["sentence"].combine_chunks(), table["gram"].combine_chunks().flatten().to_numpy()
    size = np.diff(lists.offsets.to_numpy())
    doc, local = np.repeat(np.arange(len(size)), size), lists.flatten().to_numpy()
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (local[1:] != local[:-1])
    return fit(doc[new], plain, np.cumsum(new) - 1, gram, y, grams, **options)


def score(docs: DataFrame, model: BagModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every row, from its whole text; map-only."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(col(doc_id).alias("doc_id"), col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.score(batch.column(1), reader), pa.float64())],
                                             names=["doc_id", "score"])

    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, score double")


def offending(docs: DataFrame, model: BagModel, threshold: float = 0.5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start, end, score, sentence) of each sentence with a score from ``threshold`` on; code points, end exclusive."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(col(doc_id).alias("doc_id"), col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches:
            rows, out = [], []
            for part in reader.slices(batch.column(1)):
                p = -np.expm1(-shared.value.harm(part))
                for i in np.flatnonzero(p >= threshold).tolist():
                    row = part.first + int(part.row[i])
                    at = part.bounds[part.row[i]]
                    raw = batch.column(1)[row].as_py().encode()
                    before = raw[:part.begin[i] - at].decode()
                    words = raw[part.begin[i] - at:part.end[i] - at].decode()
                    rows.append(row)
                    out.append((len(before), len(before) + len(words), float(p[i]), words))
            if rows:
                start, end, p, words = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), pa.array(start, pa.int64()), pa.array(end, pa.int64()), pa.array(p), pa.array(words)],
                    names=["doc_id", "start", "end", "score", "sentence"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, start bigint, end bigint, score double, sentence string")


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, max_rows: int = 20_000, **options) -> DataFrame:
    """The rows of ``op11_toxicity``: doc_id, held_out, score, predicted; one for each row of ``docs``.

    Trained on at most about ``max_rows`` labelled rows outside the held-out fold, whole texts; all rows are scored. Null
    and empty texts, and those without a word, score 0. A null id is hashed as the empty
    text. Without labels a sentence scores 0.5. Further columns are not read.
    """
    sample = kept(labelled(docs, labels, max_rows=max_rows), "labelled_texts")
    scored = score(docs, train(sample, **options))
    return scored.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
