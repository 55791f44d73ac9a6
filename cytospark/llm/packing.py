"""Packing token sequences by cutting-stock column generation.

Documents are tokenised and cut at the sequence length; what is left of each is
a piece. The histogram of piece lengths, in steps of a few tokens, is the demand of
a cutting-stock problem. Its linear program is solved over patterns (how many
pieces of which length share a sequence); a knapsack by dynamic programming
prices the next pattern. Pattern counts are rounded down, the rest is filled
longest first, and pieces are dealt to patterns by their rank in their length.
"""

from __future__ import annotations

import re
import struct
import threading
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cytospark.llm.tables import col, kept, small_batches, small_join
from cytospark.llm.texts import LOWER, SLICE_BYTES, WHITE, give_back, utf8

LENGTH = 4096
#: Tokens that a length is rounded up to in the program.
STEP = 8
END = 2
#: Words whose ids a worker keeps in each of two generations.
KNOWN_WORDS = 400_000

_PIECES = "doc_id {}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, size int, part int, place bigint"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordTokens:
    """Token ids (as little-endian bytes) of texts, encoded word by word.

    This tokenizer lowers case, drops white space and merges nothing across it, nor between a letter
    and a mark, so a text's ids are those of its words. Words are kept in two generations of
    at most ``most`` each; words of plain small letters need no normaliser.
    """

    #: Small letters that normalisation leaves alone.
    _PLAIN = re.compile("[a-zß-öø-ÿ]+")

    def __init__(self, path: str, most: int = KNOWN_WORDS):
        self.path, self.most = path, most
        self.timer: threading.Timer | None = None
        self.lock = threading.Lock()
        self.letters = _byte_letters()
        self.load()

    def load(self) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(self.path)
        self.model = self.tokenizer.model
        self.packed = [struct.pack("<I", i) for i in range(self.tokenizer.get_vocab_size())]
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def forget(self) -> None:
        self.tokenizer = self.model = None
        self.packed, self.young, self.old = [], {}, {}

    def encode(self, words: list[bytes]) -> list[bytes]:
        found: list = list(map(self.young.get, words))
        gaps = [i for i, ids in enumerate(found) if ids is None]
        if gaps:
            self._learn({words[i] for i in gaps})
            for i in gaps:
                found[i] = self.young[words[i]]
        return found

    def _learn(self, missing: set[bytes]) -> None:
        if len(self.young) + len(missing) > self.most:
            self.old, self.young = self.young, {}
        rest = []
        young, old, plain, tokenize, letters = self.young, self.old.get, self._PLAIN.fullmatch, self.model.tokenize, self.letters
        for word in missing:
            ids = old(word)
            if ids is None:
                text = word.decode()
                if not plain(text):
                    rest.append((word, text))
                    continue
                pieces = tokenize(text if word.isascii() else word.decode("latin-1").translate(letters))
                ids = b"".join([self.packed[t.id] for t in pieces])
            young[word] = ids
        for i in range(0, len(rest), 10_000):
            part = rest[i:i + 10_000]
            for (word, _), one in zip(part, self.tokenizer.encode_batch([t for _, t in part], add_special_tokens=False)):
                young[word] = b"".join([self.packed[i] for i in one.ids])

    def whole(self, text: bytes) -> bytes:
        return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, "<u4").tobytes()


def _byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: b for b in printable} | {b: 256 + i for i, b in enumerate(others)}


#: Seconds without a task after which a worker process forgets its words.
_FORGET_AFTER = 3.0


@lru_cache(2)
def _loaded(path: str, most: int) -> WordTokens:
    return WordTokens(path, most)


def _tokens(path: str, most: int) -> WordTokens:
    """One for each worker process, so the tasks of a stage share the known words."""
    tokens = _loaded(path, most)
    with tokens.lock:
        if tokens.timer is not None:
            tokens.timer.cancel()
        tokens.timer = None
        if tokens.tokenizer is None:
            tokens.load()
    return tokens


def _rest(tokens: WordTokens) -> None:
    """At the end of a task: unless another one comes soon, words and tokenizer go, as other stages need the memory."""
    def forget() -> None:
        with tokens.lock:
            if tokens.timer is timer:  # no task has begun since
                tokens.forget()
        give_back()

    timer = threading.Timer(_FORGET_AFTER, forget)
    timer.daemon = True
    tokens.timer = timer
    timer.start()


#: Texts with this may hold the literal of a special token, which is found before words are.
_LITERAL = b"<|"


def _texts(column: pa.Array, slice_bytes: int = SLICE_BYTES) -> Iterator[list[list[bytes] | bytes]]:
    """Words of consecutive texts, some at a time; a text with a token's literal comes whole.

    A full stop or comma between a small letter and white space is a word of its own.
    """
    offsets, data = utf8(column)
    n, low = len(offsets) - 1, 0
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + slice_bytes, "right")) - 1
        high = min(max(high, low + 1), n)
        bounds = offsets[low:high + 1] - offsets[low]
        raw = data[offsets[low]:offsets[high]]
        buffer = LOWER[raw]
        mark = (buffer == 44) | (buffer == 46)
        letter = (buffer >= 97) & (buffer <= 122)
        mark[1:] &= letter[:-1]
        mark[:1] = False
        mark[:-1] &= WHITE[buffer[1:]]
        mark[-1:] = False
        at = np.flatnonzero(mark)
        spaced = np.insert(buffer, at, 32).tobytes()
        cuts = (bounds + np.searchsorted(at, bounds)).tolist()
        out = []
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            text = spaced[a:b]
            out.append(raw[bounds[i]:bounds[i + 1]].tobytes() if _LITERAL in text else text.split())
        yield out
        low = high


def cut(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, length: int = LENGTH,
        step: int = STEP, known_words: int = KNOWN_WORDS) -> DataFrame:
    """Pieces of all documents with the checksum of their ids; map-only.

    A worker keeps the ids of up to twice ``known_words`` words, about 150 bytes each: fewer need less memory and more time.

    ``size`` is the length in steps, ``place`` the piece's number among those of its size in
    task ``part``. Store the result before use, so that a repeated task changes neither.
    """
    path = path or tokenizer_path()
    source = docs.select(col(doc_id).alias("doc_id"), col(text).alias("text"))
    end = np.array([END], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(path, known_words)
        part = TaskContext.get().partitionId()
        seen = [0] * (length // step + 2)
        for batch in batches:
            row, out = 0, []
            for texts in _texts(batch.column(1)):
                encoded = tokens.encode([w for words in texts if not isinstance(words, bytes) for w in words])
                at = 0
                for words in texts:
                    if isinstance(words, bytes):
                        ids = tokens.whole(words) + end
                    else:
                        ids = b"".join(encoded[at:at + len(words)]) + end
                        at += len(words)
                    total = len(ids) // 4
                    for start in range(0, total, length):
                        piece = ids[4 * start:4 * (start + length)]
                        n = len(piece) // 4
                        size = -(-n // step)
                        out.append((row, start, n, zlib.crc32(piece), total, size, part, seen[size]))
                        seen[size] += 1
                    row += 1
            if out:
                rows, *rest = zip(*out)
                kinds = [pa.int64()] * 4 + [pa.int32(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), *(pa.array(x, k) for x, k in zip(rest, kinds))],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "size", "part", "place"])
        _rest(tokens)

    return source.mapInArrow(run, _PIECES.format(source.schema["doc_id"].dataType.simpleString()))


def _knapsack(value: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern: how many of each size 1..capacity (value 0: size not asked for)."""
    sizes = np.flatnonzero(value > 1e-12) + 1
    best, taken = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    worth = value[sizes - 1]
    for c in range(1, capacity + 1):
        best[c], taken[c] = best[c - 1], 0
        fit = int(np.searchsorted(sizes, c, "right"))
        if fit:
            options = worth[:fit] + best[c - sizes[:fit]]
            k = int(options.argmax())
            if options[k] > best[c] + 1e-12:
                best[c], taken[c] = options[k], sizes[k]
    pattern, c = np.zeros(capacity, np.int64), capacity
    while c > 0:
        if taken[c]:
            pattern[taken[c] - 1] += 1
            c -= taken[c]
        else:
            c -= 1
    return float(best[capacity]), pattern


def _inverse(matrix: np.ndarray) -> np.ndarray:
    """By elimination with pivots, a row at a time.

    A threaded LAPACK call was seen to hang on the driver once the JVM runs; this needs none.
    """
    n = len(matrix)
    work = np.hstack((matrix.astype(float), np.eye(n)))
    for k in range(n):
        pivot = k + int(np.abs(work[k:, k]).argmax())
        if pivot != k:
            work[[k, pivot]] = work[[pivot, k]]
        work[k] /= work[k, k]
        factor = work[:, k].copy()
        factor[k] = 0
        work -= np.outer(factor, work[k])
    return work[:, n:]


def plan_patterns(demand: np.ndarray, gap: float = 2e-3, most_columns: int = 6000, stall: int = 150) -> list[tuple[int, np.ndarray]]:
    """Patterns with their counts that use up ``demand`` (pieces of size 1..capacity) exactly.

    Column generation ends at a proven relative gap, after ``stall`` patterns without a gain, or after
    ``most_columns``; the plan is whole either way, and only its padding depends on it.
    """
    capacity = len(demand)
    sizes = np.flatnonzero(demand) + 1
    if not len(sizes):
        return []
    need = demand[sizes - 1].astype(float)
    columns = np.diag((capacity // sizes).astype(float))
    inverse = np.diag(1 / np.diag(columns))
    amount = need / np.diag(columns)
    least, since = np.inf, 0
    for turn in range(1, most_columns + 1):
        since = since + 1 if amount.sum() > least * (1 - 1e-5) else 0
        least = min(least, float(amount.sum()))
        if since >= stall:
            break
        price = inverse.sum(axis=0)
        full = np.zeros(capacity)
        full[sizes - 1] = np.maximum(price, 0)
        value, pattern = _knapsack(full, capacity)
        if value <= 1 + 1e-7 or amount.sum() - (price * need).sum() / value <= gap * amount.sum():
            break
        entering = pattern[sizes - 1].astype(float)
        change = (inverse * entering).sum(axis=1)
        ratio = np.where(change > 1e-9, amount / np.where(change > 1e-9, change, 1), np.inf)
        leave = int(ratio.argmin())
        amount = amount - ratio[leave] * change
        amount[leave] = ratio[leave]
        amount = np.maximum(amount, 0)
        columns[:, leave] = entering
        row = inverse[leave] / change[leave]
        inverse -= np.outer(change, row)
        inverse[leave] = row
        if turn % 200 == 0:  # rounding errors add up
            inverse = _inverse(columns)
            amount = np.maximum((inverse * need).sum(axis=1), 0)
    left = demand.astype(np.int64).copy()
    plan = []
    for k in np.argsort(-amount, kind="stable"):
        pattern = np.zeros(capacity, np.int64)
        pattern[sizes - 1] = np.round(columns[:, k]).astype(np.int64)
        used = pattern > 0
        count = min(int(amount[k] + 1e-6), int((left[used] // pattern[used]).min()))
        if count > 0:
            plan.append((count, pattern))
            left -= count * pattern
    while left.any():  # what rounding left: longest first
        pattern, room = np.zeros(capacity, np.int64), capacity
        for size in np.flatnonzero(left)[::-1] + 1:
            n = min(int(left[size - 1]), room // size)
            pattern[size - 1] = n
            room -= n * size
            if not room:
                break
        used = pattern > 0
        count = int((left[used] // pattern[used]).min())
        plan.append((count, pattern))
        left -= count * pattern
    return plan


class Deal:
    """Which sequence and slot the piece of some rank in its size gets."""

    def __init__(self, plan: list[tuple[int, np.ndarray]], capacity: int):
        taken = np.zeros(capacity, np.int64)
        rows, sequence = [], 0
        for count, pattern in plan:
            slot = 0
            for size in np.flatnonzero(pattern)[::-1] + 1:
                each = int(pattern[size - 1])
                rows.append((size, int(taken[size - 1]), sequence, each, slot))
                taken[size - 1] += count * each
                slot += each
            sequence += count
        table = np.array(sorted(rows), np.int64).reshape(-1, 5)
        self.size, self.rank, self.sequence, self.each, self.slot = table.T
        self.begin = np.searchsorted(self.size, np.arange(capacity + 2))

    def place(self, size: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and slot of each piece."""
        at = np.empty(len(size), np.int64)
        for s in np.unique(size):
            mine = size == s
            a, b = self.begin[s], self.begin[s + 1]
            at[mine] = a + np.searchsorted(self.rank[a:b], rank[mine], "right") - 1
        since = rank - self.rank[at]
        return self.sequence[at] + since // self.each[at], self.slot[at] + since % self.each[at]


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, length: int = LENGTH,
         step: int = STEP, known_words: int = KNOWN_WORDS) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every id of every document lies in one piece; a document ends with id 2, so null and empty
    texts have one piece of one token. Repeated rows are packed as often as they occur. Only the
    histogram (length / step rows) and the patterns made from it reach the driver. Other columns
    are not read. An empty table gives no pieces.
    """
    with small_batches(docs.sparkSession, 1000):  # whole texts in both processes: few at a time
        pieces = kept(cut(docs, doc_id, text, path, length, step, known_words), "pieces")
    counts = kept(pieces.groupBy("size", "part").count(), "piece_counts")
    demand = np.zeros(length // step, np.int64)
    for row in counts.groupBy("size").agg(F.sum("count").alias("n")).collect():
        demand[row["size"] - 1] = row["n"]
    deal = Deal(plan_patterns(demand), len(demand))
    before = Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    key = F.struct("size", "part").alias("key")
    base = kept(counts.select(key, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base")), "piece_bases")
    ranked = small_join(pieces.withColumn("key", F.struct("size", "part")), base, "key", width=32)
    shared = docs.sparkSession.sparkContext.broadcast(deal)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column(5).to_numpy().astype(np.int64)
            sequence, slot = shared.value.place(size, batch.column(6).to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(slot)],
                                             names=[*batch.schema.names[:5], "sequence_id", "slot"])

    kind = pieces.schema["doc_id"].dataType.simpleString()
    dealt = ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "size",
                          (F.col("base") + F.col("place")).alias("rank")).mapInArrow(
        run, f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, slot bigint")
    # A sequence holds at most length pieces.
    earlier = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return dealt.withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0))).drop("slot")
