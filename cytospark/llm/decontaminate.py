"""Benchmark decontamination by a generalised suffix automaton.

The words of all benchmark items form one automaton. The words of a document
are streamed through it: the state gives the longest suffix read so far that
occurs in some item. Where that length reaches the window, the words are hit.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cytospark.llm.tables import col, quoted
from cytospark.llm.texts import SLICE_BYTES, fresh, released, utf8

#: Lower case for A-Z; digits, letters and all bytes of other scripts stay, the rest separates words.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
#: A token that no text can hold stands between two documents.
_BREAK = b"\x00"


def item_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORD_BYTES).split()


class Automaton:
    """Generalised suffix automaton over word numbers.

    ``window_state`` names, for every state, the state of the suffix of
    ``window`` words (-1 where the state's words are fewer); ``items`` the item
    numbers of such a state. Items shorter than a window count when read whole.
    """

    def __init__(self, items: Sequence[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.ids = sorted({name for name, _ in items})
        number = {name: i for i, name in enumerate(self.ids)}
        self.vocabulary: dict[bytes, int] = {}
        coded = [(number[name], [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words])
                 for name, words in items if words]
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, words in coded:
            last = 0
            for w in words:
                last = self._extend(last, w)
        self._mark(coded)
        pairs = {(a, b) for _, words in coded for a, b in zip(words, words[1:])}
        size = max(1, len(self.vocabulary))
        self.pairs = np.array(sorted(a * size + b for a, b in pairs), dtype=np.int64)
        self.least = min((min(len(words), window) for _, words in coded), default=0)

    def _extend(self, last: int, w: int) -> int:
        follow = self.next[last].get(w)
        if follow is not None:
            if self.length[follow] == self.length[last] + 1:
                return follow
            return self._clone(last, w, follow)
        state = self._state(self.length[last] + 1, {}, 0)
        at = last
        while at != -1 and w not in self.next[at]:
            self.next[at][w] = state
            at = self.link[at]
        if at != -1:
            follow = self.next[at][w]
            exact = self.length[follow] == self.length[at] + 1
            self.link[state] = follow if exact else self._clone(at, w, follow)
        return state

    def _state(self, length: int, follow: dict[int, int], link: int) -> int:
        self.next.append(follow)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _clone(self, at: int, w: int, follow: int) -> int:
        clone = self._state(self.length[at] + 1, dict(self.next[follow]), self.link[follow])
        while at != -1 and self.next[at].get(w) == follow:
            self.next[at][w] = clone
            at = self.link[at]
        self.link[follow] = clone
        return clone

    def _mark(self, coded: Sequence[tuple[int, list[int]]]) -> None:
        states = len(self.next)
        self.window_state = [-1] * states
        for s in sorted(range(states), key=self.length.__getitem__):
            if self.length[s] >= self.window:
                up = self.link[s]
                self.window_state[s] = s if self.length[up] < self.window else self.window_state[up]
        self.items: list[set[int]] = [set() for _ in range(states)]
        whole: list[list[tuple[int, int]]] = [[] for _ in range(states)]
        for item, words in coded:
            s = 0
            for i, w in enumerate(words, 1):
                s = self.next[s][w]
                if i >= self.window:
                    self.items[self.window_state[s]].add(item)
            if len(words) < self.window:
                whole[s].append((len(words), item))
        # Short items that end in a state or in any of its suffixes.
        self.whole: list[list[tuple[int, int]]] = [[] for _ in range(states)]
        for s in sorted(range(states), key=self.length.__getitem__):
            if s:
                self.whole[s] = whole[s] + self.whole[self.link[s]]

    def scan(self, words: list[int], base: int, hits: list[tuple[int, int]], found: set[int]) -> None:
        """Reads a run of known words; adds hit spans [from, to) and the items found."""
        state = length = 0
        follow, link, lengths = self.next, self.link, self.length
        for i, w in enumerate(words, base + 1):
            while state and w not in follow[state]:
                state = link[state]
                length = lengths[state]
            after = follow[state].get(w)
            if after is None:
                continue
            state, length = after, length + 1
            reach = 0
            if length >= self.window:
                found |= self.items[self.window_state[state]]
                reach = length
            for size, item in self.whole[state]:
                if size <= length:
                    found.add(item)
                    reach = max(reach, size)
            if reach:
                if hits and hits[-1][1] >= i - reach:
                    low = min(hits[-1][0], i - reach)
                    while len(hits) > 1 and hits[-2][1] >= low:
                        hits.pop()
                        low = min(low, hits[-1][0])
                    hits[-1] = (low, i)
                else:
                    hits.append((i - reach, i))


@dataclass
class Found:
    words: int = 0
    hits: list[tuple[int, int]] = field(default_factory=list)
    items: set[int] = field(default_factory=set)


def match_texts(automaton: Automaton, column: pa.Array) -> list[Found]:
    """Hit spans and items of each text of a column."""
    offsets, data = utf8(column)
    n, low, out = len(offsets) - 1, 0, []
    get = {**automaton.vocabulary, _BREAK: -2}.get
    size = max(1, len(automaton.vocabulary))
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + SLICE_BYTES, "right")) - 1
        high = min(max(high, low + 1), n)
        raw = data[offsets[low]:offsets[high]].tobytes().translate(_WORD_BYTES)
        cuts = (offsets[low:high + 1] - offsets[low]).tolist()
        parts: list[bytes] = []
        for a, b in zip(cuts, cuts[1:]):
            parts += (raw[a:b], b" \x00 ")
        tokens = b"".join(parts).split()
        codes = np.fromiter((get(t, -1) for t in tokens), np.int64, len(tokens))
        stops = np.flatnonzero(codes == -2)
        begins = np.concatenate(([0], stops[:-1] + 1))
        rows = [Found(int(b - a)) for a, b in zip(begins, stops)]
        if automaton.least:
            known = codes >= 0
            joined = known[:-1] & known[1:]
            at = np.flatnonzero(joined)
            pair = codes[at] * size + codes[at + 1]
            if len(automaton.pairs):
                place = np.minimum(np.searchsorted(automaton.pairs, pair), len(automaton.pairs) - 1)
                joined[at] = automaton.pairs[place] == pair
            else:
                joined[:] = False
            # A run: known words in a row whose neighbours are neighbours in an item.
            first = known.copy()
            first[1:] &= ~joined
            last = known.copy()
            last[:-1] &= ~joined
            a, b = np.flatnonzero(first), np.flatnonzero(last) + 1
            long = b - a >= automaton.least
            for s, e in zip(a[long].tolist(), b[long].tolist()):
                row = int(np.searchsorted(stops, s))
                automaton.scan(codes[s:e].tolist(), s - int(begins[row]), rows[row].hits, rows[row].items)
        out += rows
        low = high
    return out


RESULT = T.StructType([
    T.StructField("n_words", T.LongType(), False),
    T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType(), False), False), False),
    T.StructField("items", T.ArrayType(T.StringType(), False), False),
])


def _merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _pass(docs: DataFrame, text: str, into: str, items: list[tuple[str, list[bytes]]], window: int) -> DataFrame:
    """One shard's automaton over all documents, added to what earlier shards found. Map-only."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(Automaton(items, window))
    again = into in docs.columns
    schema = docs.schema if again else T.StructType([*docs.schema.fields, T.StructField(into, RESULT, False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        for batch in batches:
            names = batch.schema.names
            found = match_texts(automaton, batch.column(names.index(text)))
            before = batch.column(names.index(into)).to_pylist() if again else [None] * len(found)
            rows = [{
                "n_words": f.words,
                "spans": _merged([*f.hits, *map(tuple, old["spans"] if old else [])]),
                "items": sorted({automaton.ids[i] for i in f.items} | set(old["items"] if old else [])),
            } for f, old in zip(found, before)]
            kind = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64()))),
                              ("items", pa.list_(pa.string()))])
            new = pa.array(rows, type=kind)
            columns = [new if n == into else batch.column(i) for i, n in enumerate(names)]
            if again:
                yield pa.RecordBatch.from_arrays(columns, names=names)
            else:
                yield pa.RecordBatch.from_arrays([*columns, new], names=[*names, into])

    return docs.mapInArrow(released(run), schema)


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
                   item_text: str = "text", window: int = 13, shard_words: int = 1_000_000,
                   into: str = "decontamination") -> tuple[DataFrame, str]:
    """Documents with the word spans and item ids that occur in a benchmark.

    Returns the documents, all columns kept, with one struct column more
    (n_words, spans, items), and the name of that column: ``into``, with
    underscores in front if the documents have such a column.

    The automaton holds at most ``shard_words`` words and a shard is what goes to the
    driver and the executors; larger benchmarks are read in shards that pass over the
    documents one after the other. A single longer item makes its own shard.

    Null or empty text: no words, no hits. Item without words: never found.
    Repeated items count once; a null item id is listed as the empty string.
    """
    into = fresh(docs.columns, into)
    words = F.size(F.split(F.coalesce(col(item_text), F.lit("")), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))
    total = benchmark.agg(F.sum(words)).first()[0] or 0
    shards = max(1, math.ceil(total / shard_words))
    source = benchmark.select(F.coalesce(col(item).cast("string"), F.lit("")).alias("id"), col(item_text).alias("t"))
    for shard in range(shards):
        part = source.where(F.pmod(F.xxhash64("id", "t"), F.lit(shards)) == shard) if shards > 1 else source
        items = [(r["id"], item_words(r["t"])) for r in part.toLocalIterator()]
        docs = _pass(docs, text, into, items, window)
    return docs, into


def covered(spans: str) -> F.Column:
    """Number of words in a column of spans."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])


def contaminated(into: str, share: int = 20) -> F.Column:
    """Some word is hit, and at least one in ``share`` words."""
    hit = covered(f"{quoted(into)}.spans")
    return (hit > 0) & (hit * share >= F.col(f"{quoted(into)}.n_words"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that stay clear of the benchmark, their columns unchanged."""
    marked, into = benchmark_hits(docs, benchmark, **options)
    return marked.where(~contaminated(into)).drop(into)


@F.pandas_udf(T.StringType())
def _without_spans(texts, spans):
    import pandas as pd

    def cut(text, drop):
        if text is None or not len(drop):
            return text
        raw = text.encode()
        plain = raw.translate(_WORD_BYTES)
        flags = np.frombuffer(plain, np.uint8) != 32
        edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
        starts, stops = edges[::2], edges[1::2]
        out, at = [], 0
        for a, b in drop:
            out.append(raw[at:starts[a]])
            at = stops[b - 1]
        out.append(raw[at:])
        return b"".join(out).decode()

    return pd.Series([cut(t, s) for t, s in zip(texts, spans)])


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", share: int = 20, **options) -> DataFrame:
    """Cut the hit spans out of the texts of contaminated documents; the others stay as they are."""
    marked, into = benchmark_hits(docs, benchmark, text=text, **options)
    spans = F.when(contaminated(into, share), F.col(f"{quoted(into)}.spans")).otherwise(F.array())
    return marked.withColumn(text, _without_spans(col(text), spans.cast("array<array<bigint>>"))).drop(into)


def report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The digest of ``op4_decontamination``."""
    marked, into = benchmark_hits(docs.select("doc_id", "text"), benchmark, **options)
    part = quoted(into)
    return marked.select(
        "doc_id", F.col(f"{part}.n_words").alias("n_words"), covered(f"{part}.spans").alias("n_hit"),
        F.size(F.col(f"{part}.items")).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.col(f"{part}.items"), ","), 256).alias("items_sha256"),
        contaminated(into).alias("contaminated"),
    )


def digest(ids: Sequence[str]) -> str:
    """What ``items_sha256`` holds, for tests."""
    return hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
