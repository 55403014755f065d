"""LM scoring by a probabilistic suffix tree over words.

Counts cover every training document. The tree grows level by level: a context is a retained entry of the level
below it, an entry is retained if its count diverges from what the longest proper suffix predicts by more than naming
it costs, and growth ends where nothing is retained. There is no floor but a few occurrences, so what is gathered
grows with the corpus: words, pairs and longer grams are counted by shuffle, and the tree is broadcast only while it
is small; beyond that each block of documents asks for the entries it needs, a share of the blocks at a time, and
what no later level changes is added up at once.

Root probabilities share out all mass: known words have theirs by count, and unseen words that of the words seen
once, spread by a model of spelling over bytes. A context's entries are discounted, and what is freed goes to all
other words in proportion to the suffix's distribution. All words there could be thus sum to at most one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import drop, materialize, table, tidy
from .text import Words, mix, ragged, runs, utf8

#: Occurrences that a word and an entry need, and that a context of several words needs.
LEAST, DEEP = 2, 4
#: Words in a context at most.
DEPTH = 4
DISCOUNT = 0.5
BLOCK_BYTES = 6 << 20
#: Rows of one level of the tree that are broadcast at most, of 24 bytes each; contexts may be twice as many, of 8 bytes.
BROADCAST_ROWS = 4_000_000
#: Rounds at most in which blocks ask for a level that isn't broadcast, and blocks that one has at least.
ROUNDS, ROUND_BLOCKS = 8, 16
#: Bits of a sieve and of a slice of it at most, as powers of two.
SIEVE_BITS, SLICE_BITS = 29, 20
#: Grams that are counted together in Python, in some 60 bytes each; Spark adds those of a task before it shuffles them.
_FLUSH = 1_000_000
#: Rows that are numbered in one task, about.
_NUMBERED = 1_000_000
#: The end of a text as a word hash.
END = np.int64(-0x6A09E667F3BCC909)
#: Numbers of a rare word, an unseen one and the start of a text; other words have further ones.
RARE, UNKNOWN, START = -1, 0, 1
_WORD = (1 << 32) - 1
#: The block under which pairs of bytes are counted.
SPELLING = -1
EDGE = 256
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
ENCODED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, root_score double, score_known double, block int, ids binary"
STATES = ENCODED + ", context binary, delta binary"


def with_ends(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of each text with END after each, where each text starts, and the place of each word."""
    n = np.diff(words.first)
    first = np.concatenate([[0], np.cumsum(n + 1)])
    place = ragged(first[:-1], n)
    out = np.full(int(first[-1]), END, np.int64)
    out[place] = words.hashes()
    return out, first, place


def lookup(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The place of each wanted in sorted keys, or -1."""
    if not len(keys):
        return np.full(len(wanted), -1, np.int64)
    k = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[k] == wanted, k, -1)


def spelt(words: Words, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the pairs of bytes of the chosen words, their edges included, and where each word's begin."""
    length = words.ends[chosen] - words.starts[chosen]
    at = np.concatenate([[0], np.cumsum(length + 1)])
    before = np.full(int(at[-1]), EDGE, np.int64)
    after = before.copy()
    raw = words.low[ragged(words.starts[chosen], length)].astype(np.int64)
    before[ragged(at[:-1] + 1, length)] = raw
    after[ragged(at[:-1], length)] = raw
    return before * (EDGE + 1) + after, at


def spelling(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """log10 probability of each byte or edge after each, by code: every byte stays possible."""
    seen = np.zeros((EDGE + 1) ** 2)
    seen[codes] = counts
    seen = seen.reshape(EDGE + 1, EDGE + 1) + 0.01
    return np.log10(seen / seen.sum(axis=1, keepdims=True)).ravel()


@dataclass
class Root:
    """n tokens of v different words, the share of unseen words, and their spelling."""

    n: int
    v: int
    unknown: float
    spelling: np.ndarray

    def log10(self, counts: np.ndarray, words: Words, place: np.ndarray) -> np.ndarray:
        """log10 probabilities of tokens by their training counts; the unseen ones by their bytes."""
        p = np.log10(np.where(counts > 0, (1 - self.unknown) * counts / max(self.n, 1), self.unknown))
        new = np.flatnonzero(counts[place] == 0)
        if len(new):
            codes, at = spelt(words, new)
            p[place[new]] += np.add.reduceat(self.spelling[codes], at[:-1])
        if not self.n:  # no end was seen either: the empty spelling
            ends = np.ones(len(p), bool)
            ends[place] = False
            p[ends] += self.spelling[EDGE * (EDGE + 1) + EDGE]
        return p


@dataclass
class Level:
    """Of one level: entries sorted by key, context << 32 | word, with their log10 probability over the root's and the
    context they make with their word; and sorted contexts with the log10 weight of all other words."""

    keys: np.ndarray
    values: np.ndarray
    nexts: np.ndarray
    contexts: np.ndarray
    weights: np.ndarray

    @classmethod
    def of(cls, rows: pa.Table) -> Level:
        key, order = np.unique(rows["key"].to_numpy(), return_index=True)
        value, following = rows["value"].to_numpy()[order], rows["next"].to_numpy()[order]
        weight = (key & _WORD) == 0
        entry = ~weight
        return cls(key[entry], value[entry], following[entry].astype(np.int32), key[weight] >> 32, value[weight])

    def prepare(self) -> None:
        """A table by context, unless few have weights, and a hashed table of entries, at most half full."""
        if hasattr(self, "table"):
            return
        last = int(self.contexts[-1]) if len(self.contexts) else 0
        self.table = None
        if last <= 8 * len(self.contexts) + 1024:
            self.table = np.full(last + 2, np.nan)
            self.table[self.contexts] = self.weights
            self.contexts = self.weights = None
        bits = max(10, (2 * len(self.keys)).bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.slots = np.full(1 << bits, -1, np.int32)
        left = np.arange(len(self.keys), dtype=np.int32)
        slot = self.slot(self.keys)
        while len(left):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = left[free]
            missed = self.slots[slot] != left
            left, slot = left[missed], (slot[missed] + 1) & self.last

    def weight(self, context: np.ndarray) -> np.ndarray:
        """The weight of each context, or NaN."""
        if self.table is None:
            k = lookup(self.contexts, context)
            return np.where(k >= 0, self.weights[k], np.nan)
        # the table's last place is no context's, as aren't 0 and those below
        return self.table[np.minimum(context, len(self.table) - 1)]

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)

    def entry(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, or -1."""
        slot = self.slot(keys)
        out = self.slots[slot]
        left = np.flatnonzero(out >= 0)
        left = left[self.keys[out[left]] != keys[left]]
        while len(left):
            slot[left] = (slot[left] + 1) & self.last
            out[left] = self.slots[slot[left]]
            left = left[out[left] >= 0]
            left = left[self.keys[out[left]] != keys[left]]
        return out


@dataclass
class Sieve:
    """Tells of a key whether a level may have it, by two bits of one slice; none that it has is ever missed."""

    slices: np.ndarray

    @staticmethod
    def places(keys: np.ndarray, slices: int) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
        """The slice of each key, and the places of its bits there."""
        h = mix(keys.view(np.uint64))
        last = np.uint64((1 << SLICE_BITS) - 1)
        bits = tuple(((h >> np.uint64(k)) & last).astype(np.int64) for k in (0, SLICE_BITS))
        return ((h >> np.uint64(2 * SLICE_BITS)) & np.uint64(slices - 1)).astype(np.int64), bits

    @classmethod
    def of(cls, keys: DataFrame, n: int) -> Sieve:
        """Of n keys: 8 to 16 bits each while that stays within SIEVE_BITS."""
        slices = 1 << min(max((8 * n).bit_length() - SLICE_BITS, 0), SIEVE_BITS - SLICE_BITS)

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array(cls.places(batch.column(0).to_numpy(), slices)[0]), batch.column(0)], names=["slice", "key"])

        def mark(group: pa.Table) -> pa.Table:
            marked = np.zeros(1 << SLICE_BITS, bool)
            for place in cls.places(group["key"].to_numpy(), slices)[1]:
                marked[place] = True
            return pa.table({"slice": group["slice"][:1], "bits": pa.array([np.packbits(marked).tobytes()], pa.binary())})

        found = keys.select("key").mapInArrow(deal, "slice long, key long").groupBy("slice").applyInArrow(mark, "slice long, bits binary").toArrow()
        out = np.zeros((slices, 1 << SLICE_BITS >> 3), np.uint8)
        for k, bits in zip(found["slice"].to_pylist(), found["bits"], strict=True):
            out[k] = np.frombuffer(bits.as_buffer(), np.uint8)
        return cls(out)

    def keeps(self, keys: np.ndarray) -> np.ndarray:
        at, bits = self.places(keys, len(self.slices))
        out = np.ones(len(keys), bool)
        for place in bits:
            out &= (self.slices[at, place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 != 0
        return out


def first_contexts(ids: np.ndarray) -> np.ndarray:
    """The context of one word before each place of texts that begin with START; 0 at those."""
    out = np.zeros(len(ids), np.int64)
    out[1:] = ids[:-1]
    out[ids == START] = 0
    return out


def step(ids: np.ndarray, context: np.ndarray, delta: np.ndarray, level: Level) -> tuple[np.ndarray, np.ndarray]:
    """Contexts of the next level, and log10 probabilities over the root's after this one."""
    level.prepare()
    weight = level.weight(context)
    at = np.flatnonzero(weight == weight)
    new = delta.copy()
    new[at] += weight[at]
    entry = level.entry((context[at] << 32) | ids[at])
    hit = np.flatnonzero(entry >= 0)
    at, entry = at[hit], entry[hit]
    new[at] = level.values[entry]
    following = np.zeros(len(ids) + 1, np.int64)
    following[at + 1] = level.nexts[entry]
    following = following[:-1]
    following[ids == START] = 0
    return following, new


def settled(context: np.ndarray, left: int) -> np.ndarray:
    """Places that none of the `left` further levels can change: no context there, nor where one could grow from."""
    open_ = context > 0 if left else np.zeros(len(context), bool)
    for _ in range(left - 1):
        open_[1:] |= open_[:-1].copy()
    return ~open_


def numbered(rows: DataFrame, key: str, name: str, first: int) -> DataFrame:
    """Adds `name`: numbers without gaps from `first`. rows are materialised; key is unique."""
    n = rows.count()
    if n >= 1 << 31:
        raise ValueError("more than 2^31 words or contexts")
    buckets = -(-n // _NUMBERED) or 1
    dealt = rows.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    sizes = dict(map(tuple, dealt.groupBy("_bucket").agg(F.count("*")).collect()))
    starts, total = [], first
    for k in range(buckets):
        starts.append(total)
        total += sizes.get(k, 0)
    start = F.array(*[F.lit(x).cast("long") for x in starts])[F.col("_bucket")]
    return dealt.withColumn(name, start + F.row_number().over(Window.partitionBy("_bucket").orderBy(key)) - 1).drop("_bucket")


def retained(grams: DataFrame, v: int) -> DataFrame:
    """Of grams (s, z, n, total, p0, parent: the suffix's probability) those whose count diverges from total * parent
    upwards by more nats than it costs to name one of v words and to state its probability."""
    expected = F.col("total") * F.col("parent")
    gain = F.col("n") * F.log(F.col("n") / expected) - (F.col("n") - expected)
    cost = F.log(F.lit(float(max(v, 2)))) + 0.5 * F.log(F.greatest(F.col("total"), F.lit(2)).cast("double"))
    return grams.filter((F.col("n") > expected) & (gain > cost))


def key_of(s: Column, z: Column | int = 0) -> Column:
    return F.shiftleft(s, 32) + (z if isinstance(z, Column) else F.lit(z))


def train_and_score(docs: DataFrame, least: int = LEAST, depth: int = DEPTH, block_bytes: int = BLOCK_BYTES, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """SCORES, and score_known (of the tokens that training knows), for each row of (doc_id, text). Trains on documents whose crc32(doc_id as
    text) mod 7 is not 2.

    Null text is empty and has the end alone. A null doc_id trains and isn't held out. Repeated rows count as often
    as they stand. An empty table gives an empty one; with nothing to train on words are scored by their spelling.
    broadcast_rows changes how the tree reaches the documents, not the scores.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    plain = plain.withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False)))
    size, starts = plain.agg(F.sum(F.octet_length("text")), F.count_if(~F.col("held_out"))).first()
    blocks = max(1, -(-(size or 0) // block_bytes))
    blocked = plain.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))

    def ask(group: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, np.ndarray]] = []
        pairs = np.zeros((EDGE + 1) ** 2, np.int64)
        group = group.combine_chunks()
        data, at = utf8(group["text"])
        trains = ~group["held_out"].to_numpy(zero_copy_only=False)
        for i, j in runs(at):
            words = Words(data[at[i] : at[j]], at[i : j + 1] - at[i])
            tokens, first, place = with_ends(words)
            mine = np.repeat(trains[i:j], np.diff(first))
            key, one, back = np.unique(tokens, return_index=True, return_inverse=True)
            n = np.bincount(back, mine, len(key)).astype(np.int64)
            found.append((key, n))
            number = np.full(len(tokens), -1, np.int64)
            number[place] = np.arange(len(place))
            spell = number[one[n > 0]]
            if (spell >= 0).any():
                pairs += np.bincount(spelt(words, spell[spell >= 0])[0], minlength=len(pairs))
        key, back = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
        n = np.bincount(back, np.concatenate([c for _, c in found]), len(key)).astype(np.int64)
        code = np.flatnonzero(pairs)
        block = np.concatenate([np.full(len(key), group["block"][0].as_py(), np.int32), np.full(len(code), SPELLING, np.int32)])
        return pa.table({"block": block, "word": np.concatenate([key, code]), "n": np.concatenate([n, pairs[code]])})

    asked = materialize(blocked.groupBy("block").applyInArrow(ask, "block int, word long, n long"), "asked")
    words = asked.filter(F.col("block") != SPELLING)
    counts = materialize(words.groupBy("word").agg(F.sum("n").alias("c")).filter("c > 0"), "counts")
    n, v, once = counts.agg(F.sum("c"), F.count("*"), F.count_if(F.col("c") == 1)).first()
    n = n or 0
    unknown = max(once, 1) / (n + 1) if n else 1.0
    # at most (EDGE + 1)^2 rows
    pairs = asked.filter(F.col("block") == SPELLING).groupBy("word").agg(F.sum("n").alias("n")).toArrow()
    root = spark.sparkContext.broadcast(Root(n, v, unknown, spelling(pairs["word"].to_numpy(), pairs["n"].to_numpy())))
    symbols = materialize(numbered(counts.filter(F.col("c") >= least), "word", "id", START + 1), "symbols")
    named = counts.filter(F.col("c") < least).withColumn("id", F.lit(RARE).cast("long")).unionByName(symbols)
    answers = materialize(words.join(named, "word").select("block", "word", "c", F.col("id").cast("int").alias("id")), "answers")
    drop(asked, counts)
    tidy(spark)

    def encode(texts: pa.Table, answers: pa.Table) -> pa.Table:
        model = root.value
        key, c, id_ = (answers[x].to_numpy() for x in ("word", "c", "id")) if len(answers) else (np.zeros(0, np.int64),) * 3
        order = np.argsort(key)
        key, c, id_ = key[order], np.append(c[order], 0), np.append(id_[order], UNKNOWN)
        texts = texts.combine_chunks()
        data, at = utf8(texts["text"])
        out: list[list[np.ndarray]] = []
        ids: list[bytes] = []
        for i, j in runs(at):
            words = Words(data[at[i] : at[j]], at[i : j + 1] - at[i])
            tokens, first, place = with_ends(words)
            k = lookup(key, tokens)
            n_of = c[k]
            sum_ = lambda x, first=first: np.add.reduceat(x, first[:-1])
            p = model.log10(n_of, words, place)
            base = np.log10((n_of + 1) / (model.n + model.v + 1))
            out.append([np.diff(first), sum_((n_of > 0).astype(np.int64)), sum_(base), sum_(p), sum_(np.where(n_of > 0, p, 0.0))])
            number = np.insert(id_[k].astype(np.int32), first[:-1], START)
            start = first + np.arange(len(first))
            ids += [number[a:b].tobytes() for a, b in zip(start[:-1], start[1:], strict=True)]
        columns = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0)] * 5
        return pa.table([texts["doc_id"], texts["held_out"], *(pa.array(x.astype(np.int64)) for x in columns[:2]), *(pa.array(x.astype(float)) for x in columns[2:]), texts["block"], pa.array(ids, pa.binary())], names=[x.split()[0] for x in ENCODED.split(", ")])

    encoded = materialize(blocked.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(encode, ENCODED), "encoded")
    drop(answers)
    tidy(spark)
    small = True  # every level so far is broadcast
    shared: list = []
    states = [encoded]  # with context and delta, by rounds, once a level isn't
    rounds = max(1, min(ROUNDS, blocks // ROUND_BLOCKS))
    before: DataFrame | None = None
    totals = symbols.select(F.col("id").alias("s"), F.col("c").alias("total")).union(spark.createDataFrame([(START, int(starts or 0))], "s long, total long"))
    share = (1 - unknown) / max(n, 1)
    totals_n = symbols.count()
    for number in range(1, depth + 1):
        grams = _grams(states, shared, number).groupBy("code")
        grams = grams.agg(F.sum("n").alias("n"), F.lit(0.0).alias("delta")) if number == 1 else grams.agg(F.sum("n").alias("n"), F.min("delta").alias("delta"))
        grams = grams.filter(F.col("n") >= LEAST)
        split = grams.select(F.shiftright("code", 32).alias("s"), F.col("code").bitwiseAND(F.lit(_WORD)).alias("z"), "n", "delta")
        root_p = symbols.select(F.col("id").alias("z"), (F.col("c") * share).alias("p0"))
        tested = split.join(root_p, "z").join(totals, "s").withColumn("parent", F.col("p0") * F.pow(F.lit(10.0), F.col("delta")))
        entries = materialize(retained(tested, v).select("s", "z", "n", "total", "p0", "parent", key_of(F.col("s"), F.col("z")).alias("key")), "entries")
        entries_n = entries.count()
        if not entries_n:
            drop(entries)
            break
        if before:
            drop(before)
        entries_id = materialize(numbered(entries, "key", "id", START + 1), "entries")
        drop(entries)
        entries = entries_id
        smooth = (F.col("n") - DISCOUNT) / F.col("total")
        freed = F.greatest(1 - F.sum(smooth), F.lit(1e-12)) / F.greatest(1 - F.sum("parent"), F.lit(1e-12))
        weights = entries.groupBy("s").agg(F.log10(freed).alias("value")).select(key_of(F.col("s")).alias("key"), "value", F.lit(0).cast("long").alias("next"))
        facts = materialize(entries.select("key", F.log10(smooth / F.col("p0")).alias("value"), F.when(F.col("n") >= DEEP, F.col("id")).otherwise(0).alias("next")).unionByName(weights), "level")
        tidy(spark)
        facts_n = facts.count()
        small = small and facts_n <= broadcast_rows and totals_n <= 2 * broadcast_rows
        if small:
            shared.append(spark.sparkContext.broadcast(Level.of(facts.toArrow())))
        else:
            states = _advance(states, shared, facts, facts_n, rounds, depth - number)
            for level in shared:
                level.destroy()
            shared = []
        drop(facts)
        before = entries
        totals, totals_n = entries.select(F.col("id").alias("s"), F.col("n").alias("total")), entries_n
    return _finish(states, shared, n)


def _rows(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Values of a binary column one after the other, and where each row's begin."""
    data, at = utf8(column)
    return np.frombuffer(data.tobytes(), kind), at // np.dtype(kind).itemsize


def _union(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def _walked(batch: pa.RecordBatch | pa.Table, shared: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """ids, offsets, contexts and deltas of a batch of ENCODED or STATES rows, after the broadcast levels."""
    names = batch.schema.names
    ids, at = _rows(batch.column(names.index("ids")), np.int32)
    ids = ids.astype(np.int64)
    if "context" in names:
        context, delta = _rows(batch.column(names.index("context")), np.int32)[0].astype(np.int64), _rows(batch.column(names.index("delta")), np.float64)[0]
    else:
        context, delta = first_contexts(ids), np.zeros(len(ids))
    for level in shared:
        context, delta = step(ids, context, delta, level.value)
    return ids, at, context, delta


def _parts(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches of fewer rows, so that arrays of one number a token stay small. What Arrow keeps of batches that are done is
    given back."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)
        del batch
        pa.default_memory_pool().release_unused()


def _grams(states: list[DataFrame], shared: list, number: int) -> DataFrame:
    """(code, n, delta): context << 32 | word of all training tokens whose context is in the tree."""
    columns = [c for c in states[0].columns if c in ("ids", "context", "delta")]
    names = ["code", "n"] if number == 1 else ["code", "n", "delta"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            code = np.concatenate([c for c, _ in held])
            if number == 1:
                out = list(np.unique(code, return_counts=True))
            else:
                code, one, n = np.unique(code, return_index=True, return_counts=True)
                out = [code, n, np.concatenate([d for _, d in held])[one]]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(out[0]), pa.array(out[1].astype(np.int32)), *map(pa.array, out[2:])], names=names)

        for batch in _parts(batches):
            ids, _, context, delta = _walked(batch, shared)
            at = np.flatnonzero((context > 0) & (ids > START))
            held.append(((context[at] << 32) | ids[at], delta[at] if number > 1 else delta[:0]))
            if sum(len(c) for c, _ in held) > _FLUSH:
                yield flush()
        if held:
            yield flush()

    return _union(states).filter("not held_out").select(*columns).mapInArrow(count, "code long, n int" + ", delta double" * (number > 1))


def _map(states: DataFrame, shared: list, make: Callable[[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, np.ndarray], list], schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            yield pa.RecordBatch.from_arrays(make(batch, *_walked(batch, shared)), names=[x.split()[0] for x in schema.split(", ")])

    return states.mapInArrow(run, schema)


def _binaries(values: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.array([values[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())


def _with_states(states: DataFrame, shared: list) -> DataFrame:
    """STATES rows after the levels that are broadcast."""
    kept = len(ENCODED.split(", "))
    return _map(states, shared, lambda batch, ids, at, context, delta: [*batch.columns[:kept], _binaries(context.astype(np.int32), at), _binaries(delta, at)], STATES)


def _advance(states: list[DataFrame], shared: list, facts: DataFrame, n: int, rounds: int, left: int) -> list[DataFrame]:
    """STATES rows, by rounds, after a level of n facts that isn't broadcast; `left` further ones follow. The tables read go
    as soon as what follows them is written."""
    spark = facts.sparkSession
    sieve = spark.sparkContext.broadcast(Sieve.of(facts, n))
    dealt = len(states) == rounds
    out = []
    for k in range(rounds):
        mine = states[k] if dealt else states[0].filter(F.pmod(F.col("block"), F.lit(rounds)) == k)
        out.append(materialize(_answered(_with_states(mine, shared) if shared else mine, facts, sieve, left), "states"))
        if dealt:
            drop(mine)
        tidy(spark)
    if not dealt:
        drop(*states)
    sieve.destroy()
    return out


def _answered(states: DataFrame, facts: DataFrame, sieve: Broadcast, left: int) -> DataFrame:
    """STATES rows after a level: blocks of documents ask for the keys they have."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches, 1024):
            ids, at, context, _ = _walked(batch, [])
            block = np.repeat(batch.column(batch.schema.names.index("block")).to_numpy(), np.diff(at))
            for k in np.unique(block):
                on = np.flatnonzero((context > 0) & (block == k))
                one = context[on] << 32
                key = np.unique(np.concatenate([one, one | np.where(ids[on] > START, ids[on], 0)]))
                key = key[sieve.value.keeps(key)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), k, np.int32)), pa.array(key)], names=["block", "key"])

    def answer(texts: pa.Table, answers: pa.Table) -> pa.Table:
        texts = texts.combine_chunks()
        level = Level.of(answers) if len(answers) else Level(*(np.zeros(0, kind) for kind in (np.int64, float, np.int32, np.int64, float)))
        ids, at, context, delta = _walked(texts, [])
        context, delta = step(ids, context, delta, level)
        done = settled(context, left)
        more = np.add.reduceat(np.where(done, delta, 0.0), at[:-1])
        known = np.add.reduceat(np.where(done & (ids != UNKNOWN), delta, 0.0), at[:-1])
        delta[done] = 0
        ids[done & (ids != START)] = UNKNOWN
        new = {"root_score": texts["root_score"].to_numpy() + more, "score_known": texts["score_known"].to_numpy() + known, "ids": _binaries(ids.astype(np.int32), at)}
        new |= {"context": _binaries(context.astype(np.int32), at), "delta": _binaries(delta, at)}
        return pa.table({c: new[c] if c in new else texts[c] for c in [x.split()[0] for x in STATES.split(", ")]})

    columns = [c for c in states.columns if c in ("block", "ids", "context", "delta")]
    asks = states.select(*columns).mapInArrow(ask, "block int, key long")
    answers = asks.join(facts, "key").select("block", "key", "value", "next")
    return states.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(answer, STATES)


def _finish(states: list[DataFrame], shared: list, n: int) -> DataFrame:
    def make(batch: pa.RecordBatch, ids: np.ndarray, at: np.ndarray, context: np.ndarray, delta: np.ndarray) -> list:
        more = np.add.reduceat(delta, at[:-1]) if len(at) > 1 else np.zeros(0)
        known = np.add.reduceat(np.where(ids != UNKNOWN, delta, 0.0), at[:-1]) if len(at) > 1 else np.zeros(0)
        doc_id, held_out, n_tokens, n_known, base, root, root_known = batch.columns[:7]
        total = pa.array(np.full(len(more), n, np.int64))
        return [doc_id, held_out, n_tokens, n_known, total, base, pa.array(root.to_numpy() + more), pa.array(root_known.to_numpy() + known)]

    return _map(_union(states), shared, make, SCORES + ", score_known double")


def op2_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return train_and_score(table(spark, sf_dir, "documents"))
