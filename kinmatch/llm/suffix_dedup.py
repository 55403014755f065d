"""Exact substring dedup by two-stage suffix sorting.

Each start of a LENGTH-byte string belongs to the least hash of the short windows inside the string (its anchor),
so that equal strings have equal anchors. Occurrences of an anchor are gathered by hash; equal contexts of an
anchor are sorted once, with their multiplicity. Anchors that occur once have no repeats and go no further, and the
strings of an anchor with very many contexts are counted by 128-bit hashes, which no single place need hold.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from .store import drop, materialize, table, tidy
from .text import _power_tables, mix, ragged, runs, utf8

LENGTH = 400
GRAM = 32
#: Bytes of text looked at together; also the most that the low bits of a key can number.
CHUNK = 1 << 20
#: Contexts sorted together, in bytes.
UNIT = 1 << 18
#: An anchor with more contexts than this isn't sorted in one place: its strings are dealt out one by one, by hash.
MANY = 2_000
_BYTES = np.random.default_rng(20240608).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Sums S with S[b] - S[a], divided by the base to the power a, a hash of data[a:b]."""
    power, _ = _power_tables(len(data) + 1)
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * power[: len(data)])])


def range_hash(sums: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    _, inverse = _power_tables(len(sums))
    return mix((sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64))


def sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """Least of each run of `width` keys: prefix and suffix minima of blocks of that width."""
    n = len(keys) - width + 1
    rows = -(-len(keys) // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    blocks = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors(data: np.ndarray, at: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Of texts of at most CHUNK bytes in all: text number, anchor hash, context hash, anchor's place, first and last
    start that belong to it. Places are within the text. A context is all bytes of the strings of an anchor."""
    none = (np.zeros(0, np.int64),) * 6
    if len(data) < length:
        return none
    sums = prefix_hash(data)
    places = np.arange(len(data) - gram + 1)
    hashes = range_hash(sums, places, places + gram)
    least = sliding_least((hashes & ~np.uint64(CHUNK - 1)) | places.astype(np.uint64), length - gram + 1)
    owner = (least & np.uint64(CHUNK - 1)).astype(np.int64)
    count = np.maximum(np.diff(at) - length + 1, 0)
    starts = ragged(at[:-1], count)
    if not len(starts):
        return none
    own = owner[starts]
    new = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    a = starts[new]
    b = starts[np.concatenate([new[1:], [len(starts)]]) - 1]
    p = own[new]
    text = np.searchsorted(at, a, side="right") - 1
    context = mix(range_hash(sums, a, b + length) + (p - a).astype(np.uint64))
    base = at[text]
    return text, hashes[p].view(np.int64), context.view(np.int64), p - base, a - base, b - base


def segments(at: np.ndarray, length: int = LENGTH) -> Iterator[tuple[int, int, int, int]]:
    """(first text, end text, from byte, to byte): chunks of whole texts, and a longer text in overlapping pieces."""
    for i, j in runs(at, CHUNK):
        if at[j] - at[i] <= CHUNK:
            yield i, j, int(at[i]), int(at[j])
        else:
            for a in range(int(at[i]), max(int(at[j]) - length + 1, int(at[i]) + 1), CHUNK - length + 1):
                yield i, j, a, min(a + CHUNK, int(at[j]))


def suffix_order(text: np.ndarray, wanted: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """The wanted places (sorted) of text, and those that sorting them needs, in the order of their suffixes' first
    `length` bytes; equal ones in any order.

    Two stages: suffixes smaller than their successors are sorted directly; each of the others starts with a byte
    no less than the next one's first and is induced by a scan over buckets of first bytes.
    """
    n = len(text)
    word = text.astype(np.int64)
    following = np.append(word[1:], -1)
    # a run of equal bytes has the kind of its last; the last suffix is greater than what follows it
    change = np.flatnonzero(word != following)
    kind = (following[change] > word[change])[np.searchsorted(change, np.arange(n))]
    # induction of a place needs all up to the next directly sorted one
    need = np.zeros(n, bool)
    need[wanted] = True
    direct_at = np.append(np.flatnonzero(kind), n)
    upto = np.minimum(direct_at[np.searchsorted(direct_at, wanted)], n - 1)
    delta = np.zeros(n + 1, np.int64)
    np.add.at(delta, wanted, 1)
    np.add.at(delta, upto + 1, -1)
    need |= np.cumsum(delta[:-1]) > 0
    direct = np.flatnonzero(kind & need)
    padded = np.concatenate([text + np.uint8(1), np.zeros(length, np.uint8)])  # UTF-8 has no byte 255
    rows = np.lib.stride_tricks.sliding_window_view(padded, length)
    # equal strings are sorted once
    sums = prefix_hash(padded)
    _, first, back = np.unique(range_hash(sums, direct, direct + length), return_index=True, return_inverse=True)
    order = np.argsort(np.ascontiguousarray(rows[direct[first]]).view(f"S{length}").ravel(), kind="stable")
    place = np.empty(len(first), np.int64)
    place[order] = np.arange(len(first))
    direct = direct[np.argsort(place[back], kind="stable")]
    # buckets: induced suffixes of a first byte stand before the directly sorted ones
    buckets: list[list[np.ndarray]] = [[] for _ in range(256)]
    sorted_of = {int(c): direct[text[direct] == c] for c in np.unique(text[direct])}
    induced = need & ~kind
    out: list[np.ndarray] = []

    def induce(places: np.ndarray) -> None:
        before = places[places > 0] - 1
        before = before[induced[before]]
        c = text[before]
        for byte in np.unique(c):
            buckets[byte].append(before[c == byte])

    if induced[n - 1]:
        buckets[text[n - 1]].append(np.array([n - 1]))
    for byte in range(256):
        k = 0
        while k < len(buckets[byte]):  # runs of one byte induce within their own bucket
            out.append(buckets[byte][k])
            induce(buckets[byte][k])
            k += 1
        if byte in sorted_of:
            out.append(sorted_of[byte])
            induce(sorted_of[byte])
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def adjacent_equal(text: np.ndarray, order: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Whether the common prefix of each suffix and the one before it has `length` bytes or more."""
    same = np.zeros(len(order), bool)
    if len(order) < 2:
        return same
    limit = len(text) - length
    alive = np.flatnonzero((order[1:] <= limit) & (order[:-1] <= limit)) + 1
    a, b = order[alive - 1], order[alive]
    step = 8
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    for k in range(0, length, step):
        k = min(k, length - 8)
        ok = (words[a + k] == words[b + k]).all(axis=1)
        alive, a, b = alive[ok], a[ok], b[ok]
        if not len(alive):
            break
    same[alive] = True
    return same


def repeated_starts(parts: list[bytes], counts: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """For each part (all bytes of some strings): starts of those that stand elsewhere in the parts, or whose part
    stands more than once."""
    text = np.frombuffer(b"".join(parts), np.uint8)
    sizes = np.array([len(p) for p in parts], np.int64)
    at = np.concatenate([[0], np.cumsum(sizes)])
    starts = ragged(at[:-1], sizes - length + 1)
    weight = np.zeros(len(text), np.int64)
    weight[starts] = np.repeat(counts, sizes - length + 1)
    order = suffix_order(text, starts, length)
    run = np.cumsum(~adjacent_equal(text, order, length)) - 1
    total = np.bincount(run, weight[order])[run] if len(order) else np.zeros(0)
    hit = np.zeros(len(text), bool)
    hit[order[(total >= 2) & (weight[order] > 0)]] = True
    return [np.flatnonzero(hit[at[k] : at[k + 1]]) for k in range(len(parts))]


def cover(starts: np.ndarray, length: int = LENGTH) -> list[tuple[int, int]]:
    """Unions of start .. start + length for sorted starts."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > length)
    a = starts[np.concatenate([[0], cut + 1])]
    b = starts[np.concatenate([cut, [len(starts) - 1]])] + length
    return list(zip(a.tolist(), b.tolist(), strict=True))


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """RESULT for each row of (doc_id, text): bytes covered by a `length`-byte string that starts anywhere else go.

    Null text is empty; rows with null or repeated doc_id are documents of their own, and equal rows repeat each
    other. Texts are whole at any size. An empty table gives an empty one; other columns are not read.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    keyed = plain.withColumn("th", F.xxhash64("text"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = utf8(batch.column(1))
            ids, th = batch.column(0), batch.column(2).to_numpy()
            for i, j, a, b in segments(at, length):
                own = at[i : j + 1] if b - a == at[j] - at[i] else np.array([a, b])
                k, g, c, p, first, last = anchors(data[a:b], own - a, length)
                shift = a - int(at[i])
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(k + i)), pa.array(th[k + i]), pa.array(g), pa.array(c), pa.array((p + shift).astype(np.int32)), pa.array((first + shift).astype(np.int32)), pa.array((last + shift).astype(np.int32))],
                    names=["doc_id", "th", "g", "c", "p", "a", "b"],
                )

    found = materialize(keyed.select("doc_id", "text", "th").mapInArrow(find, "doc_id long, th long, g long, c long, p int, a int, b int"), "anchors")
    contexts = found.groupBy("g", "c").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "th", "p", "a", "b")).alias("at"))
    contexts = materialize(contexts, "contexts")
    groups = contexts.groupBy("g").agg(F.sum("n").alias("n_all"), F.count("*").alias("kinds")).filter("n_all > 1")
    repeated = materialize(contexts.join(groups, "g").select("g", "c", "n", "kinds", "at.*"), "repeated")
    drop(contexts)
    tidy(docs.sparkSession)
    # a group of equal contexts has one string for each start, of that multiplicity: nothing to sort
    alone = repeated.filter("kinds = 1").select("g", "c", F.lit(0).alias("from"), (F.col("b") - F.col("a") + length).cast("int").alias("to"))

    def with_texts(contexts: DataFrame) -> DataFrame:
        wanted = contexts.groupBy("doc_id", "th").agg(F.collect_list(F.struct("g", "c", "n", "p", "a", "b")).alias("cuts"))
        return keyed.join(wanted, keyed.doc_id.eqNullSafe(wanted.doc_id) & (keyed.th == wanted.th)).select("text", "cuts")

    def slice_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["u", "g", "c", "n", "skip", "part"]
        for batch in batches:
            rows: list[tuple] = []
            size = 0
            cut_lists = batch.column(1)
            for k, value in enumerate(batch.column(0)):
                data = value.as_buffer().to_pybytes()
                for cut in cut_lists[k].as_py():
                    rows.append((cut["g"], cut["g"], cut["c"], cut["n"], 0, data[cut["a"] : cut["b"] + length]))
                    size += len(rows[-1][-1])
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), _PARTS, strict=True)], names=names)
                        rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), _PARTS, strict=True)], names=names)

    def strings_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for k, value in enumerate(batch.column(0)):
                data = memoryview(value.as_buffer())
                for cut in batch.column(1)[k].as_py():
                    for at in range(cut["a"], cut["b"] + 1):
                        rows.append((cut["g"], cut["c"], cut["n"], at - cut["a"], xxh3_128_digest(data[at : at + length])))
                    if len(rows) > 50_000:
                        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), _STRINGS, strict=True)], names=["g", "c", "n", "at", "h"])
                        rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), _STRINGS, strict=True)], names=["g", "c", "n", "at", "h"])

    def covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            out = [(g, c, x, y) for g, c, starts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), lists, strict=True) for x, y in cover(np.sort(starts.values.to_numpy()), length)]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True) if out else [()] * 4, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], names=["g", "c", "from", "to"])

    busy = with_texts(repeated.filter(F.col("kinds") > MANY)).mapInArrow(strings_out, "g long, c long, n long, at int, h binary")
    busy = materialize(busy.dropDuplicates(["g", "c", "at"]), "strings")
    again = busy.groupBy("h").agg(F.sum("n").alias("total")).filter("total > 1").select("h")
    dealt = busy.join(again, "h").groupBy("g", "c").agg(F.collect_list("at").alias("starts")).mapInArrow(covered, "g long, c long, from int, to int")
    parts = with_texts(repeated.filter((F.col("kinds") > 1) & (F.col("kinds") <= MANY))).mapInArrow(slice_out, "u long, g long, c long, n long, skip int, part binary")
    # repeated rows would bring a context twice
    parts = parts.groupBy("u", "g", "c", "skip").agg(F.first("n").alias("n"), F.first("part").alias("part"))

    def sort_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def flush(rows: list[tuple]) -> pa.RecordBatch:
            hits = repeated_starts([r[5] for r in rows], np.array([r[4] for r in rows], np.int64), length)
            out = [(r[1], r[2], r[3] + x, r[3] + y) for r, h in zip(rows, hits, strict=True) for x, y in cover(h, length)]
            columns = zip(*out, strict=True) if out else [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], names=["g", "c", "from", "to"])

        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if size > UNIT and row[0] != held[-1][0]:
                    yield flush(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[5])
        if held:
            yield flush(held)

    marks = parts.select("u", "g", "c", "skip", "n", "part").repartition("u").sortWithinPartitions("u").mapInArrow(sort_parts, "g long, c long, from int, to int")
    marks = materialize(alone.union(marks).union(dealt), "marks")
    drop(busy, repeated)
    tidy(docs.sparkSession)
    spans = found.join(marks, ["g", "c"]).select("doc_id", "th", (F.col("a") + F.col("from")).alias("from"), (F.col("a") + F.col("to")).alias("to"))
    spans = materialize(spans.groupBy("doc_id", "th").agg(F.collect_list(F.struct("from", "to")).alias("spans")), "spans")

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            lists = batch.column(2)
            for k, value in enumerate(batch.column(1)):
                data = value.as_buffer()
                kept, at, removed, n_spans = hashlib.sha256(), 0, 0, 0
                end = -1
                for x, y in sorted((s["from"], s["to"]) for s in lists[k].as_py() or ()):
                    if x > end:
                        n_spans += 1
                        kept.update(data[at:x])
                    x = max(x, at)
                    removed += max(0, y - x)
                    at = end = max(at, y)
                kept.update(data[at:])
                rows.append((data.size, removed, n_spans, kept.hexdigest()))
            columns = zip(*rows, strict=True) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True))], names=[x.split()[0] for x in RESULT.split(", ")])

    joined = keyed.join(spans, keyed.doc_id.eqNullSafe(spans.doc_id) & (keyed.th == spans.th), "left").select(keyed.doc_id, "text", "spans")
    return joined.mapInArrow(cut_out, RESULT)


_STRINGS = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
_PARTS = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))
