"""Language identification by rank-order profiles of character n-grams.

A profile lists a language's most frequent n-grams by rank. A document's own
most frequent n-grams are compared with each profile: the out-of-place distance
adds up how far every n-gram is from its rank there, or the full length of the
profile where it is missing. The nearest profile names the language.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cytospark.llm.tables import col, quoted
from cytospark.llm.texts import fresh, released, utf8

#: n-grams of one to three letters; a word's edge counts as a letter of its own.
ORDERS = (1, 2, 3)
PROFILE_SIZE = 400
UNKNOWN = "und"

_SLICE = 1 << 18
_EDGE = 32
_CODE_POINTS = 0x110000


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(_CODE_POINTS)), bool, _CODE_POINTS)


class Slice:
    """Letters of consecutive texts as small numbers, words parted by one edge (number 0)."""

    def __init__(self, texts: list[bytes]):
        # No text holds the separator: its own zero bytes are read as white space.
        joined = b"\x00".join(t.replace(b"\x00", b" ") for t in texts)
        points = np.frombuffer(("\x00" + joined.decode("utf-8", "replace").lower() + "\x00").encode("utf-32-le", "surrogatepass"), np.uint32)
        doc = np.cumsum(points == 0) - 1
        letter = _letters()[points]
        points = np.where(letter, points, _EDGE)
        keep = letter.copy()
        keep[0] = True
        keep[1:] |= letter[:-1]  # the first non-letter after a letter is the word's edge
        points, self.doc = points[keep], doc[keep]
        self.alphabet = np.unique(np.append(points, _EDGE))
        table = np.zeros(int(self.alphabet[-1]) + 1, np.int64)
        # The edge comes first in the order of n-grams, as white space does.
        rest = self.alphabet[self.alphabet != _EDGE]
        self.alphabet = np.concatenate((np.array([_EDGE], self.alphabet.dtype), rest))
        table[self.alphabet] = np.arange(len(self.alphabet))
        self.codes = table[points]
        self.rows = len(texts)
        k = len(self.alphabet)
        self.offsets = {1: 0, 2: k, 3: k + k * k}
        self.span = k + k * k + k * k * k

    def grams(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(document, n-gram number) of each n-gram that lies in one word and its edges."""
        k, c, d = len(self.alphabet), self.codes, self.doc
        for n in ORDERS:
            if len(c) < n:
                continue
            if n == 1:
                ok, code, doc = c != 0, c, d
            elif n == 2:
                a, b = c[:-1], c[1:]
                ok, code = (a != 0) | (b != 0), a * k + b
                doc = np.where(a != 0, d[:-1], d[1:])
            else:
                a, b, e = c[:-2], c[1:-1], c[2:]
                ok, code, doc = b != 0, (a * k + b) * k + e, d[1:-1]
            yield doc[ok], code[ok] + self.offsets[n]

    def packed(self, numbers: np.ndarray) -> np.ndarray:
        """n-gram numbers as 21 bits for each code point, the same in every slice."""
        k, points = len(self.alphabet), self.alphabet.astype(np.int64)
        out = np.zeros(len(numbers), np.int64)
        for n in ORDERS:
            at = (numbers >= self.offsets[n]) & (numbers < self.offsets[n] + k ** n)
            rest = numbers[at] - self.offsets[n]
            value = np.zeros(len(rest), np.int64)
            for i in range(n - 1, -1, -1):
                value |= points[rest % k] << (21 * (2 - i))
                rest = rest // k
            out[at] = value
        return out


def _slices(column: pa.Array) -> Iterator[tuple[int, Slice]]:
    offsets, data = utf8(column)
    n, low = len(offsets) - 1, 0
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + _SLICE, "right")) - 1
        high = min(max(high, low + 1), n)
        raw = data[offsets[low]:offsets[high]].tobytes()
        cuts = (offsets[low:high + 1] - offsets[low]).tolist()
        yield low, Slice([raw[a:b] for a, b in zip(cuts, cuts[1:])])
        low = high


def _counted(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
    starts = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1])))
    return keys[starts], np.diff(np.append(starts, len(keys)))


def _count_languages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of n-grams by language, added up over the task."""
    totals: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def merged(parts):
        grams, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        return grams, np.bincount(place, np.concatenate([p[1] for p in parts]), len(grams)).astype(np.int64)

    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), object)
        for low, part in _slices(batch.column(1)):
            names, of = np.unique(langs[low:low + part.rows].astype(str), return_inverse=True)
            keys, counts = _counted([of[doc] * part.span + g for doc, g in part.grams()])
            for i, name in enumerate(names):
                at = slice(*np.searchsorted(keys, (i * part.span, (i + 1) * part.span)))
                totals.setdefault(name, []).append((part.packed(keys[at] - i * part.span), counts[at]))
                if len(totals[name]) >= 32:
                    totals[name] = [merged(totals[name])]
    for name, parts in totals.items():
        grams, counts = merged(parts)
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(grams), pa.string()), pa.array(grams), pa.array(counts)],
                                         names=["lang", "gram", "n"])


def gram_text(packed: int) -> str:
    return "".join(chr(p) for p in (packed >> 42, packed >> 21 & 0x1FFFFF, packed & 0x1FFFFF) if p)


def fit_profiles(docs: DataFrame, text: str = "text", lang: str = "lang", size: int = PROFILE_SIZE) -> DataFrame:
    """Profiles (lang, gram, rank) from all documents with a text and a language."""
    rows = docs.where(col(lang).isNotNull() & col(text).isNotNull()).select(col(lang).cast("string"), col(text))
    counts = rows.mapInArrow(released(_count_languages), "lang string, gram bigint, n bigint")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size).select(
        "lang", "gram", "rank")


class Profiles:
    """Ranks of every profiled n-gram in every language."""

    def __init__(self, rows: list[tuple[str, int, int]], size: int = PROFILE_SIZE):
        self.size = size
        self.langs = sorted({r[0] for r in rows})
        place = {name: i for i, name in enumerate(self.langs)}
        self.grams = np.unique(np.array([r[1] for r in rows], np.int64))
        self.ranks = np.full((len(self.grams) + 1, len(self.langs)), -1, np.int32)
        for name, gram, rank in rows:
            self.ranks[np.searchsorted(self.grams, gram), place[name]] = rank - 1

    def nearest(self, part: Slice) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest language (-1: no letters) and the score of each text."""
        best, score = np.full(part.rows, -1), np.zeros(part.rows)
        keys, counts = _counted([doc * part.span + g for doc, g in part.grams()])
        if not len(keys):
            return best, score
        doc = keys // part.span
        order = np.argsort(doc * (int(counts.max()) + 1) - counts, kind="stable")
        begins = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
        rank = np.arange(len(doc)) - np.repeat(begins, np.diff(np.append(begins, len(doc))))
        top = rank < self.size
        chosen, rank = order[top], rank[top]
        doc, grams = doc[chosen], part.packed(keys[chosen] % part.span)
        at = np.minimum(np.searchsorted(self.grams, grams), max(0, len(self.grams) - 1))
        if len(self.grams):
            at = np.where(self.grams[at] == grams, at, len(self.grams))
        begins = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
        present = doc[begins]
        if not self.langs:
            return best, score
        distance = np.empty((len(present), len(self.langs)))
        for i in range(len(self.langs)):
            there = self.ranks[at, i]
            off = np.where(there < 0, self.size, np.abs(there - rank))
            distance[:, i] = np.add.reduceat(off, begins)
        near = np.argmin(distance, axis=1)
        most = np.diff(np.append(begins, len(doc))) * self.size
        best[present] = near
        score[present] = 1 - distance[np.arange(len(near)), near] / most
        return best, np.clip(score, 0, 1)


def collect_profiles(profiles: DataFrame, size: int = PROFILE_SIZE, max_langs: int = 5_000) -> Profiles:
    """Profiles on the driver: ``size`` rows for each language, whatever the corpus.

    A column of more than ``max_langs`` values holds no languages; that is an error.
    """
    rows = profiles.limit(max_langs * size + 1).collect()
    if len(rows) > max_langs * size:
        raise ValueError(f"more than {max_langs} languages: choose another column or raise max_langs")
    return Profiles([tuple(r) for r in rows], size)


def identify(docs: DataFrame, profiles: Profiles, text: str = "text", into: str = "language"
             ) -> tuple[DataFrame, str]:
    """All columns and rows of ``docs`` with a struct (lang_pred, score) more; map-only.

    Returns the frame and the struct's name: ``into``, with underscores in front if taken.
    Null, empty and letterless texts: ``und``, score 0. Whole texts are counted. Equal
    distances: the first language by name. n-grams of equal count rank by length, then code
    point. Without any profile (nothing to learn from) every text is ``und``.
    """
    into = fresh(docs.columns, into)
    shared = docs.sparkSession.sparkContext.broadcast(profiles)
    kind = T.StructType([T.StructField("lang_pred", T.StringType(), False), T.StructField("score", T.DoubleType(), False)])
    schema = T.StructType([*docs.schema.fields, T.StructField(into, kind, False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        names = np.array([*known.langs, UNKNOWN], object)  # -1 is the last
        for batch in batches:
            column = batch.column(batch.schema.names.index(text))
            found = [known.nearest(part) for _, part in _slices(column)]
            best = np.concatenate([f[0] for f in found]) if found else np.zeros(0, int)
            score = np.concatenate([f[1] for f in found]) if found else np.zeros(0)
            new = pa.StructArray.from_arrays([pa.array(names[best].tolist(), pa.string()), pa.array(score, pa.float64())],
                                             names=["lang_pred", "score"])
            yield pa.RecordBatch.from_arrays([*batch.columns, new], names=[*batch.schema.names, into])

    return docs.mapInArrow(released(run), schema), into


def held_out(doc_id: str = "doc_id", fold: int = 3, remainder: int = 1) -> F.Column:
    """Rows set aside from learning; a null id is hashed as the empty text."""
    return F.pmod(F.crc32(F.coalesce(col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(fold)) == remainder


def learn(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
          size: int = PROFILE_SIZE) -> Profiles:
    """Profiles of all rows that are not held out."""
    return collect_profiles(fit_profiles(docs.where(~held_out(doc_id)), text, lang, size), size)


def report(docs: DataFrame) -> DataFrame:
    """The rows of ``op2_language_id``."""
    marked, into = identify(docs.select("doc_id", "text"), learn(docs))
    return marked.select("doc_id", held_out().alias("held_out"), F.col(f"{quoted(into)}.lang_pred").alias("lang_pred"),
                         F.col(f"{quoted(into)}.score").alias("score"))


def keep_known(docs: DataFrame) -> DataFrame:
    """Documents whose text is in some known language; columns unchanged.

    Rejected: no letters at all, or not one n-gram of any profile.
    """
    marked, into = identify(docs, learn(docs))
    part = quoted(into)
    return marked.where((F.col(f"{part}.lang_pred") != UNKNOWN) & (F.col(f"{part}.score") > 0)).drop(into)
