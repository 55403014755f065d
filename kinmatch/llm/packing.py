"""Best-fit packing in bulk-synchronous supersteps.

Pieces of equal length are interchangeable, and so are sequences of equal gap: the state is two tables of runs, pieces
by length and gaps by size, range-parted by size. In a superstep all ranges are swept at once, each by a task of its own:
pieces in the order of their rank (the longest first) take the smallest gap that fits, so that no two claim one; gaps
that shrink move to the range they now belong to, and pieces that found none look in the next range. Once all have
looked everywhere and nothing moves, as many sequences are opened as the pieces left need at least. The rows
themselves are sorted and ranked by Spark and look up their place by (length, rank).
"""

from __future__ import annotations

import bisect
import itertools
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from .store import materialize, table
from .text import ragged, utf8

SIZE = 4096
END_ID = 1
#: Ranges of sizes, each swept by one task.
RANGES = 4
#: Pieces of one length that one task ranks, about.
RANKED = 1_000_000
#: Chunks and words that a worker remembers.
_CACHE_CHUNKS, _CACHE_WORDS = 500_000, 500_000
#: ASCII punctuation.
_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Byte-level BPE's characters for bytes: printable ones stand for themselves, the others follow from 256 on.
_PLAIN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_CHARS = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _PLAIN)}
_ENDS = frozenset(_PUNCTUATION.encode())
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECES + ", sequence_id long, offset long"


class ChunkEncoder:
    """Ids of texts by chunk between ASCII white space: the tokenizer drops white space and never merges across it.

    Chunks seen before are looked up; the table starts anew at _CACHE_CHUNKS chunks.
    """

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.reset()

    def reset(self) -> None:
        #: Numbers of slices of the pool: of chunks, lower-case words, and what stands after words.
        self.known: dict[bytes, int] = {}
        self.words: dict[bytes, int] = {}
        self.rests: dict[bytes, int] = {}
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0
        self.start, self.length, self.n = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64), 0

    def shrink(self) -> None:
        """Forgets chunks, and words too once they are many; words are fewer and come back more often."""
        words, k = list(self.words), np.fromiter(self.words.values(), np.int64, len(self.words))
        ids, counts = self.pool[ragged(self.start[k], self.length[k])], self.length[k]
        self.reset()
        if len(words) <= _CACHE_WORDS:
            self.words = dict(zip(words, self._add(ids, counts), strict=True))

    def _add(self, ids: np.ndarray, counts: np.ndarray) -> range:
        """Puts slices of ids into the pool; their numbers."""
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while self.n + len(counts) > len(self.start):
            self.start, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.length))
        self.pool[self.used : self.used + len(ids)] = ids
        self.start[self.n : self.n + len(counts)] = self.used + np.cumsum(counts) - counts
        self.length[self.n : self.n + len(counts)] = counts
        self.used += len(ids)
        self.n += len(counts)
        return range(self.n - len(counts), self.n)

    @staticmethod
    def _split(chunk: bytes) -> tuple[bytes | None, bytes]:
        """A lower-case word of letters and the punctuation after it; None and the chunk for any other."""
        text = chunk.decode("utf-8", "replace")
        word = text.lower()
        if word.isalpha() and text.isalpha() and "\u03a3" not in text and unicodedata.is_normalized("NFC", text):
            return word.encode(), b""
        letters = text.rstrip(_PUNCTUATION)
        word = letters.lower()
        if word.isalpha() and letters.isalpha() and (letters.isascii() or "\u03a3" not in letters and unicodedata.is_normalized("NFC", letters)):
            return word.encode(), text[len(letters) :].encode()
        return None, chunk

    def _plain(self, text: bytes) -> list[int]:
        return self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids

    def _learn(self, chunks: list[bytes]) -> None:
        lows: list[bytes | None] = []
        rests: list[bytes] = []
        for chunk in chunks:
            low, rest = chunk.lower(), b""
            if not low.isalpha():  # of bytes: ASCII letters
                if low[-1] in _ENDS and low[:-1].isalpha():
                    low, rest = low[:-1], low[-1:]
                else:
                    low, rest = self._split(chunk)
            lows.append(low)
            rests.append(rest)
        word = [-2 if low is None else self.words.get(low, -1) for low in lows]
        if -1 in word:
            new = list(dict.fromkeys([low for low, k in zip(lows, word, strict=True) if k == -1]))
            tokenize = self.model.tokenize  # a word of letters is one word to the model, whose bytes have characters
            lists = [[t.id for t in tokenize(low.decode() if low.isascii() else low.decode("latin-1").translate(_BYTE_CHARS))] for low in new]
            counts = np.fromiter(map(len, lists), np.int64, len(lists))
            fresh = dict(zip(new, self._add(np.fromiter(itertools.chain.from_iterable(lists), np.uint32, int(counts.sum())), counts), strict=True))
            self.words.update(fresh)
            word = [fresh[low] if k == -1 else k for low, k in zip(lows, word, strict=True)]
        for rest in set(rests).difference(self.rests):
            ids = np.array(self._plain(rest) if rest else [], np.uint32)
            self.rests[rest] = self._add(ids, np.array([len(ids)]))[0]
        nothing = self.rests.setdefault(b"", -1)
        if nothing < 0:
            nothing = self.rests[b""] = self._add(np.zeros(0, np.uint32), np.zeros(1, np.int64))[0]
        word = np.array(word, np.int64)
        word[word == -2] = nothing
        rest = np.fromiter([self.rests[r] for r in rests], np.int64, len(rests))
        whole = rest == nothing  # the word's own slice will do
        two = np.column_stack([word[~whole], rest[~whole]]).ravel()
        word[~whole] = self._add(self.pool[ragged(self.start[two], self.length[two])], self.length[two].reshape(-1, 2).sum(axis=1))
        self.known.update(zip(chunks, word.tolist(), strict=True))

    def ids(self, text: bytes) -> np.ndarray:
        chunks = text.split()
        if not chunks:
            return np.zeros(0, np.uint32)
        if len(self.known) > _CACHE_CHUNKS:
            self.shrink()
        k = np.fromiter(map(self.known.get, chunks, itertools.repeat(-1)), np.int64, len(chunks))
        missing = np.flatnonzero(k < 0).tolist()
        if missing:
            new = [chunks[x] for x in missing]
            self._learn(list(dict.fromkeys(new)))
            k[missing] = [self.known[chunk] for chunk in new]
        return self.pool[ragged(self.start[k], self.length[k])]


_encoders: dict[str, ChunkEncoder] = {}


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(docs: DataFrame, tokenizer: str | None = None, size: int = SIZE, forget: bool = False) -> DataFrame:
    """A row for each piece of at most `size` ids of a document, whose ids end with END_ID. tokenizer: a path, on every
    executor. forget: workers drop their table of chunks after each task, for jobs whose other steps need the memory."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer or tokenizer_path()
        encoder = _encoders.get(path) or _encoders.setdefault(path, ChunkEncoder(path))
        for batch in batches:
            data, at = utf8(batch.column(1))
            raw, doc_ids = memoryview(data), batch.column(0).to_pylist()
            rows: list[tuple] = []
            for k, doc_id in enumerate(doc_ids):
                ids = np.append(encoder.ids(bytes(raw[at[k] : at[k + 1]])), np.uint32(END_ID)).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), size)):
                    part = ids[start : start + size]
                    rows.append((doc_id, piece, start, len(part), zlib.crc32(part.tobytes())))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in PIECES.split(", ")])
        if forget:
            encoder.reset()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, PIECES)


#: Rows of the state. A piece run has the ranks first .. first + n of its length; a gap run the sequences first .. first + n;
#: a placed run the ranks first .. first + n, `each` to a sequence from `sequence` on, beginning at `offset`.
PIECE, GAP, PLACED_RUN = 0, 1, 2
STATE = "kind int, range int, size int, first long, n long, sequence long, each int, offset int"
Run = tuple[int, int, int, int, int, int, int, int]


def range_of(length: int, size: int) -> int:
    return (length - 1) * RANGES // size


def sweep(rows: list[Run], here: int, size: int) -> list[Run]:
    """One range's new state: its pieces, by rank, fill the smallest gap of the range that holds them.

    A gap is filled with as many equal pieces as it holds, as best fit would do one by one, because a gap just used is
    then the smallest that fits. Pieces without a gap go on to the next range.
    """
    gaps: defaultdict[int, list[tuple[int, int]]] = defaultdict(list)
    for kind, _, gap, first, n, *_ in sorted(rows):
        if kind == GAP:
            gaps[gap].append((first, n))
    order = sorted(gaps)
    out: list[Run] = []

    def leave(gap: int, first: int, n: int) -> None:
        if not gap or not n:
            return
        if range_of(gap, size) != here:
            out.append((GAP, range_of(gap, size), gap, first, n, 0, 0, 0))
            return
        if not gaps[gap]:
            bisect.insort(order, gap)
        gaps[gap].append((first, n))

    for length, rank, left in sorted(((r[2], r[3], r[4]) for r in rows if r[0] == PIECE), key=lambda p: (-p[0], p[1])):
        while left:
            k = bisect.bisect_left(order, length)
            if k == len(order):
                out.append((PIECE, here + 1, length, rank, left, 0, 0, 0))
                break
            gap = order[k]
            first, n = gaps[gap].pop()
            if not gaps[gap]:
                order.pop(k)
            each = gap // length
            whole = min(n, left // each)
            rest = left - whole * each if whole < n else 0
            done = whole * each + rest
            out.append((PLACED_RUN, -1, length, rank, done, first, each, size - gap))
            leave(gap - each * length, first, whole)
            if rest:
                leave(gap - rest * length, first + whole, 1)
            leave(gap, first + whole + bool(rest), n - whole - bool(rest))
            rank, left = rank + done, left - done
    return out + [(GAP, here, gap, first, n, 0, 0, 0) for gap, runs in gaps.items() for first, n in runs]


def open_sequences(rows: list[Run], opened: int, size: int) -> list[Run]:
    """The longest of the pieces, which fit no gap, each in a sequence of its own: as many as all need at least, by what
    they hold together and by those that can't share one. The others look for gaps from their own range on."""
    waiting = sorted(((r[2], r[3], r[4]) for r in rows), key=lambda p: (-p[0], p[1]))
    need = max(-(-sum(length * n for length, _, n in waiting) // size), sum(n for length, _, n in waiting if 2 * length > size))
    out: list[Run] = []
    for length, rank, n in waiting:
        now = min(n, need)
        if now:
            out.append((PLACED_RUN, -1, length, rank, now, opened, 1, 0))
            if length < size:
                out.append((GAP, range_of(size - length, size), size - length, opened, now, 0, 0, 0))
            need, opened = need - now, opened + now
        if n > now:
            out.append((PIECE, range_of(length, size), length, rank + now, n - now, 0, 0, 0))
    return out


def best_fit(counts: DataFrame, size: int = SIZE) -> DataFrame:
    """Placed runs of STATE for counts (length, n). Each superstep is one job; the driver learns how many pieces are
    left, wait and moved, and how many sequences were opened."""

    def run(group: pa.Table, opening: bool) -> pa.Table:
        rows = list(zip(*(group.column(c).to_pylist() for c in group.column_names), strict=True))
        here = rows[0][1]
        if here == RANGES and not opening:
            return group  # they wait for the others
        new = open_sequences(rows, rows[0][5], size) if opening else sweep(rows, here, size)
        return pa.table([pa.array(c, t) for c, t in zip(zip(*new, strict=True), _STATE_TYPES, strict=True)], names=[c.split()[0] for c in STATE.split(", ")])

    none = [F.lit(0).cast(kind).alias(name) for name, kind in (("sequence", "long"), ("each", "int"), ("offset", "int"))]
    state = counts.select(F.lit(PIECE).alias("kind"), F.lit(RANGES).alias("range"), F.col("length").cast("int").alias("size"), F.lit(0).cast("long").alias("first"), F.col("n").cast("long").alias("n"), *none)
    own = F.floor((F.col("size") - 1) * RANGES / size).cast("int")
    piece = F.col("kind") == PIECE
    steps: list[DataFrame] = []
    opening, opened, moved = True, 0, 0
    while True:
        seen = Observation()
        if opening:  # only pieces that wait are touched
            going = state.filter(piece).withColumn("sequence", F.lit(opened).cast("long"))
            new = going.groupBy("range").applyInArrow(lambda group: run(group, True), STATE).unionByName(state.filter(~piece))
        else:
            new = state.groupBy("range").applyInArrow(lambda group: run(group, False), STATE)
        left = F.when(piece, F.col("n"))
        watched = new.observe(
            seen, F.sum(left).alias("left"), F.sum(F.when(F.col("range") == RANGES, left)).alias("waiting"), F.sum(F.when(F.col("kind") == PLACED_RUN, F.col("n"))).alias("moved"),
            F.max(F.when((F.col("kind") == PLACED_RUN) & (F.col("offset") == 0), F.col("sequence") + F.col("n"))).alias("opened"),
        )
        steps.append(materialize(watched, "packing"))
        now = seen.get
        state = steps[-1].filter(F.col("kind") != PLACED_RUN)
        if not now["left"]:
            break
        if opening:
            opened, moved, opening = now["opened"], 0, False
            continue
        moved += now["moved"] or 0
        if now["waiting"] == now["left"]:
            opening = not moved
            if not opening:  # gaps have changed since pieces passed them
                state = state.withColumn("range", F.when(piece, own).otherwise(F.col("range")))
                moved = 0
    placed = steps[0]
    for step in steps[1:]:
        placed = placed.unionByName(step)
    return placed.filter(F.col("kind") == PLACED_RUN)


_STATE_TYPES = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())


def pack(parts: DataFrame, size: int = SIZE) -> DataFrame:
    """Adds sequence_id and offset to rows with doc_id, piece, start, length and ids_crc32.

    `length` is from 1 to `size`. Rows of equal length are ranked by (salt, doc_id, piece, ids_crc32); equal rows
    are interchangeable. An empty table gives an empty one. What reaches the driver are counts of lengths, split by salts where
    RANKED rows and more have one, and placed runs, which are about as many as lengths.
    """
    spark = parts.sparkSession
    lengths = materialize(parts.groupBy("length").agg(F.count("*").alias("n")), "lengths")
    placed = sorted((r["size"], r["first"], r["sequence"], r["each"], r["offset"]) for r in best_fit(lengths, size).collect()) if lengths.head(1) else []
    runs = np.array(placed, np.int64).reshape(-1, 5)
    split = lengths.select("length", F.ceil(F.col("n") / RANKED).alias("salts"))
    salted = parts.join(F.broadcast(split), "length").withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.col("salts")).cast("int")).select(*[x.split()[0] for x in PIECES.split(", ")], "salt")
    counted = np.array(salted.groupBy("length", "salt").agg(F.count("*").alias("n")).orderBy("length", "salt").collect(), np.int64).reshape(-1, 3)
    ends = np.cumsum(counted[:, 2]) - counted[:, 2]
    starts = np.searchsorted(counted[:, 0], counted[:, 0])
    model = spark.sparkContext.broadcast(((counted[:, 0] << 32) + counted[:, 1], ends - ends[starts] if len(ends) else ends, (runs[:, 0] << 48) + runs[:, 1], runs))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, before, keys, runs = model.value
        for batch in batches:
            *kept, salt, number = (batch.column(k) for k in range(batch.num_columns))
            length = kept[3].to_numpy()
            rank = before[np.searchsorted(buckets, (length << 32) + salt.to_numpy())] + number.to_numpy() - 1
            run = runs[np.searchsorted(keys, (length << 48) + rank, side="right") - 1]
            along = rank - run[:, 1]
            where = [pa.array(run[:, 2] + along // run[:, 3]), pa.array(run[:, 4] + along % run[:, 3] * length)]
            yield pa.RecordBatch.from_arrays([*kept, *where], names=[x.split()[0] for x in PLACED.split(", ")])

    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    return salted.withColumn("number", F.row_number().over(order).cast("long")).mapInArrow(place, PLACED)


def pack_documents(docs: DataFrame, tokenizer: str | None = None, size: int = SIZE, forget: bool = False) -> DataFrame:
    """Packs documents (doc_id, text) into sequences of at most `size` ids; only longer documents are cut.

    Null text is empty and holds the end id alone; null and repeated doc_id are kept as rows of their own; other
    columns are not read. Every sequence is filled from offset 0 without gaps.
    """
    return pack(materialize(pieces(docs, tokenizer, size, forget), "pieces"), size)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
