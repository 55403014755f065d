"""Near-duplicate passages by compact windows.

For each of several hashes, a Cartesian tree over the hashed shingles of a document says for which stretch each
shingle is the least: all passages in that stretch share it as their signature. Documents meet in equal signatures of
windows that hold a passage of full length, and what stands around those is compared there.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .graph import components
from .groups import pairs_within, whole_groups
from .simhash import spanning
from .store import drop, materialize, table, tidy
from .text import Words, mix, ragged, runs, utf8

WORDS = 50
WIDTH = 5
SIMILARITY = 0.8
#: Hash functions; a passage is compared if it agrees with another in one: all but 0.2^4 at similarity 0.8.
HASHES = 4
RESULT = "doc_id long, class_id long, n_links long, n_passages long, passages string"
_FLUSH_ROWS = 20_000
#: Contexts of a group that one place compares; of larger groups each two blocks of half as many meet in a place.
MANY = 16_384
#: Pairs of contexts compared at once, and contexts of groups that are compared together.
_PAIRS, _SMALL = 50_000, 64
#: Documents, about, that show which signatures are frequent: those that so many of them have. Their rows are dealt over
#: salts, at most so many to each, about.
SHOWN, FREQUENT, SALTED = 2000, 8, 2000
#: Parts in which groups are compared one after the other, so that the disk holds the contexts of one part at a time.
PARTS = 2
#: Bits of the maps by which contexts that share too little are told apart.
MAP_BITS = 2048
_SEEDS = np.random.default_rng(20240609).integers(1, 2**63, HASHES, dtype=np.uint64)
_LAST = np.iinfo(np.uint64).max


def shingle_ids(data: np.ndarray, at: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each run of `width` words, and where each text's begin. Texts of fewer words have none."""
    words = Words(data, at)
    h = words.hashes().view(np.uint64)
    n = np.diff(words.first)
    m = np.maximum(n - width + 1, 0)
    first = np.concatenate([[0], np.cumsum(m)])
    rolled = np.zeros(max(len(h) - width + 1, 0), np.uint64)
    for k in range(width):
        rolled = mix(rolled + h[k : k + len(rolled)] + np.uint64(k + 1))
    take = np.repeat(words.first[:-1] - first[:-1], m) + np.arange(first[-1])
    return rolled[take], first


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Leftmost place of the least of each run of `width` values, by their high bits."""
    bits = np.uint64(max(1, len(values).bit_length()))
    keys = (values >> bits << bits) | np.arange(len(values), dtype=np.uint64)
    n, rows = len(values) - width + 1, -(-len(values) // width)
    padded = np.full(rows * width, _LAST, np.uint64)
    padded[: len(keys)] = keys
    blocks = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(behind[:n], ahead[width - 1 : width - 1 + n]) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def cartesian_tree(keys: list[int], lower: int, upper: int, places: list[int]) -> tuple[list[int], list[int]]:
    """For each key in order the stretch of places over which it is the least (leftmost on ties): from after the last
    smaller or equal key's place to before the next smaller one's."""
    left, right = [0] * len(keys), [upper] * len(keys)
    stack: list[int] = []
    for k, key in enumerate(keys):
        while stack and keys[stack[-1]] > key:
            right[stack.pop()] = places[k] - 1
        left[k] = places[stack[-1]] + 1 if stack else lower
        stack.append(k)
    return left, right


def compact_windows(ids: np.ndarray, first: np.ndarray, least: int, hashes: int = HASHES) -> tuple[np.ndarray, ...]:
    """text, hash number, signature, and c, l, r within the text for all windows of at least `least` shingles.

    The stretches of least that are long enough belong to shingles that are least of some run of `least`; what is
    smaller on either side of such a one is again such a one, so the tree is built over those alone. A shingle equal
    to the one before it is passed over: a run of one shingle counts by its first.
    """
    out: list[tuple[np.ndarray, ...]] = []
    none = np.zeros(0, np.int64)
    if len(ids) < least:
        return (none,) * 6
    same = np.zeros(len(ids), bool)
    same[1:] = ids[1:] == ids[:-1]
    same[first[:-1][first[:-1] < len(ids)]] = False
    count = np.maximum(np.diff(first) - least + 1, 0)
    starts = np.repeat(first[:-1] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    for k in range(hashes):
        values = mix(ids ^ _SEEDS[k])
        values[same] = _LAST
        c = np.unique(sliding_argmin(values, least)[starts])
        c = c[~same[c]]
        if not len(c):
            continue
        text = np.searchsorted(first, c, side="right") - 1
        bits = np.uint64(max(1, len(values).bit_length()))
        order = (values[c] >> bits).tolist()
        places = c.tolist()
        cut = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1], [True]])).tolist()
        left: list[int] = []
        right: list[int] = []
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            t = int(text[a])
            x, y = cartesian_tree(order[a:b], int(first[t]), int(first[t + 1]) - 1, places[a:b])
            left += x
            right += y
        base = first[text]
        l, r = np.array(left) - base, np.array(right) - base
        ok = r - l + 1 >= least
        out.append((text[ok], np.full(int(ok.sum()), k), ids[c[ok]].view(np.int64), (c - base)[ok], l[ok], r[ok]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (none,) * 6


def pack_place(c: np.ndarray, k: np.ndarray, before: np.ndarray, after: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Place, hash number, and how far the window and the context reach from c (each below 256), in one long."""
    return (((c.astype(np.int64) << 8 | k) << 8 | before) << 8 | after) << 8 | end


def unpack_place(place: np.ndarray) -> tuple[np.ndarray, ...]:
    return place >> 32, place >> 24 & 255, place >> 16 & 255, place >> 8 & 255, place & 255


def around(ids: np.ndarray, low: np.ndarray, c: np.ndarray, high: np.ndarray, least: int) -> np.ndarray:
    """A row for each place c of texts that have ids[low:high]: the shingles that passages of `least` through c can hold,
    c's in the middle, as 32 bits; 0 beyond the text."""
    at = c[:, None] + np.arange(1 - least, least)
    there = (at >= low[:, None]) & (at < high[:, None])
    return np.where(there, (ids[np.where(there, at, 0)] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), np.uint32(0))


def window_sums(x: np.ndarray, least: int, axis: int = 1) -> np.ndarray:
    pad = [(0, 0)] * x.ndim
    pad[axis] = (1, 0)
    sums = np.moveaxis(np.cumsum(np.pad(x, pad), axis=axis, dtype=np.int16), axis, -1)
    return np.moveaxis(sums[..., least:] - sums[..., :-least], -1, axis)


def near_passages(a: np.ndarray, b: np.ndarray, least: int, similarity: float, facts: tuple[np.ndarray, ...] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For each row of two matrices of around(): where passages of `least` shingles start in either that have a Jaccard
    similarity of at least `similarity`, both holding the shingle in the middle; -1 for none.

    Rows with enough equal places are done. Of the others those that share enough shingles at all try every pair of
    starts, by sums over the table of which places are equal. facts: those of Maps.facts().
    """
    if facts is None:
        both, n = Maps.of(np.concatenate([a, b]), least), len(a)
        facts = both.facts(np.arange(n), np.arange(n) + n)
    whole_a, own, fewest_a, before_a, whole_b, other, fewest_b, before_b = facts
    equal = np.where(whole_a & whole_b, window_sums((a == b) & (a != 0), least), -1)
    start = equal.argmax(axis=1)
    most = equal[np.arange(len(a)), start]
    enough = int(np.ceil(2 * similarity / (1 + similarity) * least - 1e-9))
    done = (most == least) | (most >= enough) & ~own & ~other
    left, right = np.where(done, start, -1), np.where(done, start, -1)
    rows = np.flatnonzero(~done & whole_a.any(axis=1) & whole_b.any(axis=1))
    if not len(rows):
        return left, right
    row = np.arange(len(rows), dtype=np.uint64)[:, None] << np.uint64(32)
    keys, wanted = np.sort(row | np.sort(b[rows], axis=1), axis=None, kind="stable"), (row | a[rows]).ravel()
    shared = (keys[np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)] == wanted).reshape(len(rows), -1) & (a[rows] != 0)
    # a passage with repeated shingles has fewer of them to share
    need = np.ceil(similarity / (1 + similarity) * (fewest_a + fewest_b)[rows] - 1e-9)
    rows = rows[(whole_a[rows] & (window_sums(shared, least) >= need[:, None])).any(axis=1)]
    plain = rows[~own[rows] & ~other[rows]]
    for k in range(0, len(plain), 256):
        part = plain[k : k + 256]
        common = window_sums(window_sums((a[part][:, :, None] == b[part][:, None, :]) & (a[part] != 0)[:, :, None], least, 1), least, 2)
        common = np.where(whole_a[part][:, :, None] & whole_b[part][:, None, :], common, -1).reshape(len(part), -1)
        best = common.argmax(axis=1)
        ok = common[np.arange(len(part)), best] >= enough
        left[part[ok]], right[part[ok]] = (x[ok] for x in np.divmod(best, whole_b.shape[1]))
    twice = rows[own[rows] | other[rows]]
    for k in range(0, len(twice), 128):
        part = twice[k : k + 128]
        left[part], right[part] = _near_with_repeats(a[part], b[part], whole_a[part], whole_b[part], before_a[part], before_b[part], least, similarity)
    return left, right


def places_before(x: np.ndarray) -> np.ndarray:
    """Of each place of a matrix of around() the last place before it that holds the same shingle, or -1."""
    out = np.full(x.shape, -1, np.int8)
    place = np.arange(x.shape[1])
    for k in range(0, len(x), 256):
        part = x[k : k + 256]
        out[k : k + 256] = np.where((part[:, :, None] == part[:, None, :]) & (place[None, :] < place[:, None]), place.astype(np.int8) + np.int8(1), np.int8(0)).max(axis=2) - 1
    return out


def first_in_window(before: np.ndarray, least: int) -> np.ndarray:
    """Of each row and window (first axes) the places that lie in it and hold a shingle for the first time there."""
    place = np.arange(before.shape[1])
    start = np.arange(before.shape[1] - least + 1)[:, None]
    return ((place >= start) & (place < start + least))[None] & (before[:, None, :] < start[None].astype(np.int8))


def _near_with_repeats(a: np.ndarray, b: np.ndarray, whole_a: np.ndarray, whole_b: np.ndarray, before_a: np.ndarray, before_b: np.ndarray, least: int, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """near_passages() of rows that hold shingles twice: each counts once for a window."""
    own, other = first_in_window(before_a, least), first_in_window(before_b, least)
    inside = window_sums((a[:, :, None] == b[:, None, :]) & (a != 0)[:, :, None], least, 2) > 0
    common = np.matmul(own.astype(np.float32), inside.astype(np.float32))
    total = own.sum(axis=2)[:, :, None] + other.sum(axis=2)[:, None, :]
    value = np.where(whole_a[:, :, None] & whole_b[:, None, :], common / (total - common), -1.0).reshape(len(a), -1)
    best = value.argmax(axis=1)
    ok = value[np.arange(len(a)), best] >= similarity - 1e-6
    left, right = np.divmod(best, whole_b.shape[1])
    return np.where(ok, left, -1), np.where(ok, right, -1)


@dataclass
class Maps:
    """Of rows of around(): bit maps of their shingles, how many shingles the maps don't show, how many different ones each
    passage has at least, which windows are whole, which rows hold a shingle twice, and where each was before."""

    bits: np.ndarray
    lost: np.ndarray
    least: np.ndarray
    whole: np.ndarray
    twice: np.ndarray
    before: np.ndarray

    @classmethod
    def of(cls, parts: np.ndarray, least: int) -> Maps:
        place = (parts * np.uint32(0x9E3779B1)) >> np.uint32(32 - MAP_BITS.bit_length() + 1)
        bits = np.zeros((len(parts), MAP_BITS // 64), np.uint64)
        for k in range(parts.shape[1]):
            rows = np.flatnonzero(parts[:, k])
            bits[rows, place[rows, k] >> 6] |= np.uint64(1) << (place[rows, k] & np.uint32(63)).astype(np.uint64)
        ordered = np.sort(parts, axis=1)
        different = ((ordered[:, 1:] != ordered[:, :-1]) & (ordered[:, 1:] != 0)).sum(axis=1) + (ordered[:, 0] != 0)
        shown = np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        twice = (parts != 0).sum(axis=1) > different
        whole = window_sums(parts != 0, least) == least
        before, fewest = np.full(parts.shape, -1, np.int8), np.full(len(parts), least)
        rows = np.flatnonzero(twice)
        before[rows] = places_before(parts[rows])
        for k in range(0, len(rows), 512):
            some = rows[k : k + 512]
            fewest[some] = np.where(whole[some], first_in_window(before[some], least).sum(axis=2), least).min(axis=1)
        return cls(bits, different - shown, fewest, whole, twice, before)

    def part(self, rows: slice) -> Maps:
        return Maps(self.bits[rows], self.lost[rows], self.least[rows], self.whole[rows], self.twice[rows], self.before[rows])

    def facts(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of rows to be compared: which windows are whole, whether a shingle is repeated, the fewest different ones, and where each was before."""
        return self.whole[i], self.twice[i], self.least[i], self.before[i], self.whole[j], self.twice[j], self.least[j], self.before[j]

    def may_link(self, common: np.ndarray, lost: np.ndarray, least: np.ndarray, similarity: float) -> np.ndarray:
        """Whether bits in common and those not shown can make up what near passages share at least."""
        return common + lost >= similarity / (1 + similarity) * least - 1e-9

    def pairs(self, i: np.ndarray, j: np.ndarray, similarity: float) -> np.ndarray:
        common = np.bitwise_count(self.bits[i] & self.bits[j]).sum(axis=1, dtype=np.int16)
        return self.may_link(common, np.minimum(self.lost[i], self.lost[j]), self.least[i] + self.least[j], similarity)

    def table(self, i: np.ndarray, j: np.ndarray, similarity: float) -> np.ndarray:
        common = np.zeros((len(i), len(j)), np.int16)
        for w in range(self.bits.shape[1]):
            common += np.bitwise_count(self.bits[i, w][:, None] & self.bits[j, w][None, :])
        return self.may_link(common, np.minimum(self.lost[i][:, None], self.lost[j][None, :]), self.least[i][:, None] + self.least[j][None, :], similarity)


def resolve(parts: np.ndarray, root: np.ndarray, least: int, similarity: float, maps: Maps | None = None) -> tuple[np.ndarray, ...]:
    """Rows i, j of a matrix of around() and where their near_passages() start, so that with `root`, the least row
    known to be reachable from each, all rows are joined that any chain of near passages joins."""
    n = len(parts)
    maps = maps or Maps.of(parts, least)
    out = [np.zeros((4, 0), np.int64)]
    every = np.arange(n)
    # of rows with different roots one at least isn't the first row's
    for at in range(0, n, 64):
        i = every[at : at + 64]
        i = i[root[i] != root[0]]
        if not len(i):
            continue
        x, y = np.nonzero(maps.table(i, every, similarity))
        x = i[x]
        ok = (root[x] != root[y]) & ((x < y) | (root[y] == root[0]))
        x, y = x[ok], y[ok]
        for b in range(0, len(x), 2048):  # a few at a time, as rows that these join need no comparison
            u, v = x[b : b + 2048], y[b : b + 2048]
            ok = root[u] != root[v]
            u, v = u[ok], v[ok]
            left, right = near_passages(parts[u], parts[v], least, similarity, maps.facts(u, v))
            hit = left >= 0
            if hit.any():
                out.append(np.stack([u[hit], v[hit], left[hit], right[hit]]))
                root = spanning(np.concatenate([u[hit], every]), np.concatenate([v[hit], root]), n)
    return tuple(np.concatenate(out, axis=1))


def group_links(rows: pa.Table, least: int, similarity: float) -> pa.RecordBatch:
    """The links of whole groups (pair, place, d, ctx, part): each with its first, then what that leaves apart."""
    pair, place, d, ctx = (rows.column(x).to_numpy() for x in range(4))
    again = np.concatenate([[False], (pair[1:] == pair[:-1]) & (place[1:] == place[:-1]) & (ctx[1:] == ctx[:-1])])
    if again.any():  # rows of one doc_id and text
        rows = rows.filter(pa.array(~again))
        pair, place, d, ctx = pair[~again], place[~again], d[~again], ctx[~again]
    matrix = np.frombuffer(utf8(rows.column(4))[0].tobytes(), np.uint32).reshape(len(d), -1)
    cut = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (place[1:] != place[:-1]), [True]]))
    first, sizes = cut[:-1], np.diff(cut)
    maps = Maps.of(matrix, least)
    found = [np.zeros((4, 0), np.int64)]

    def meet(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ok = maps.pairs(i, j, similarity)
        i, j = i[ok], j[ok]
        left, right = near_passages(matrix[i], matrix[j], least, similarity, maps.facts(i, j))
        hit = left >= 0
        found.append(np.stack([i, j, left, right])[:, hit])
        return i[hit], j[hit]

    own = np.repeat(first, sizes)
    member = np.flatnonzero(own != np.arange(len(d)))
    root = np.arange(len(d))
    for b in range(0, len(member), _PAIRS):
        i, j = meet(member[b : b + _PAIRS], own[member[b : b + _PAIRS]])
        root[i] = j
    left = np.add.reduceat(root != own, first, dtype=np.int64)
    small = (left > 0) & (sizes > 2) & (sizes <= _SMALL)
    for i, j in pairs_within(first[small], sizes[small], _PAIRS):
        ok = (root[i] != root[j]) & (i != own[i])
        meet(i[ok], j[ok])
    for g in np.flatnonzero((left > 0) & (sizes > _SMALL)):
        a, e = cut[g], cut[g + 1]
        links = resolve(matrix[a:e], root[a:e] - a, least, similarity, maps.part(slice(a, e)))
        found.append(np.stack(links) + np.array([[a], [a], [0], [0]]))
    i, j, x, y = np.concatenate(found, axis=1)
    columns = [ctx[i], ctx[j], (least - 1 - x).astype(np.int32), (least - 1 - y).astype(np.int32), d[i], d[j]]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["x", "y", "shift", "yshift", "xd", "yd"])


def link_passages(docs: DataFrame, words: int = WORDS, width: int = WIDTH, similarity: float = SIMILARITY) -> DataFrame:
    """RESULT for each row of (doc_id, text): the smallest doc_id of its class (itself at least), how many links join
    it, and its passages as from-to in words.

    Documents link if they hold passages of `words` words whose sets of `width`-word shingles have a Jaccard similarity
    of at least `similarity`. In a group of equal signatures every context is met once: copies link to the first that
    has it, and different contexts are compared until all are joined that near passages join; those already joined
    aren't linked again, so no pairs of a group are spelt out. Null text is empty; shorter texts have no passages; rows of one doc_id and text count
    once and get the same result; null doc_id has a null class unless others are in it. An empty table gives an empty
    one, and other columns are not read.
    """
    least = words - width + 1
    if not 0 < least <= 255:
        raise ValueError("passages have from width to width + 254 words")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    # a row's key: equal rows share it
    keyed = plain.withColumn("d", F.xxhash64("doc_id", "text"))
    window_columns = "d long, sig long, place long, ctx long, salt int"
    n_rows = keyed.count()
    salts = max(2, n_rows // SALTED)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = utf8(batch.column(1))
            d = batch.column(0).to_numpy()
            for i, j in runs(at):
                ids, first = shingle_ids(data[at[i] : at[j]], at[i : j + 1] - at[i], width)
                t, k, sig, c, l, r = compact_windows(ids, first, least)
                # the context: what stands around c, as passages see it
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(ids + np.uint64(7)) * _odd_powers(len(ids)))])
                a = np.maximum(first[t], first[t] + c - least + 1)
                b = np.minimum(first[t + 1], first[t] + c + least)
                ctx = mix((sums[b] - sums[a]) * _inverse_powers(len(ids))[a] + (first[t] + c - a).astype(np.uint64) * np.uint64(1 << 32) + (b - a).astype(np.uint64)) if len(t) else np.zeros(0, np.uint64)
                # passages of least length don't reach further than that from c
                place = pack_place(c, k, np.minimum(c - l, least - 1), np.minimum(r - c, least - 1), b - first[t] - c)
                own = mix(sig.view(np.uint64) + k.astype(np.uint64)).view(np.int64)
                salt = np.zeros(len(own), np.int32)
                if len(frequent):
                    salt = np.where(frequent[np.minimum(np.searchsorted(frequent, own), len(frequent) - 1)] == own, 1 + d[t + i] % salts, 0).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(d[t + i]), pa.array(own), pa.array(place), pa.array(ctx.view(np.int64)), pa.array(salt)], names=[x.split()[0] for x in window_columns.split(", ")])

    # a bounded sample says which signatures many documents have, so that their rows needn't meet in one task
    frequent = np.zeros(0, np.int64)
    shown = keyed.filter(F.pmod("d", F.lit(max(1, n_rows // SHOWN))) == 0).select("d", "text").mapInArrow(find, window_columns)
    frequent = np.sort(np.array([r[0] for r in shown.select("sig", "d").distinct().groupBy("sig").agg(F.count("*").alias("n")).filter(F.col("n") >= FREQUENT).collect()], np.int64))
    # one exchange: a signature's first and last document come by window, and one document's own are dropped
    same = Window.partitionBy("sig", "salt")
    found = keyed.select("d", "text").mapInArrow(find, window_columns)
    repeated = found.withColumn("a", F.min("d").over(same)).withColumn("b", F.max("d").over(same)).filter("salt > 0 or a <> b").select(
        "d", F.col("sig").alias("pair"), F.shiftright("place", 32).cast("int").alias("c"), "ctx", (F.shiftright("place", 32) + F.col("place").bitwiseAND(255)).cast("int").alias("e")
    )
    met = materialize(repeated, "met")
    tidy(docs.sparkSession)
    variants = met.groupBy("pair", "ctx").agg(F.min(F.struct("d", "c")).alias("rep"), F.max("d").alias("last"))
    same_set = F.struct(F.count("*").alias("kinds"), F.bit_xor(F.xxhash64("ctx")).alias("x"), F.bit_xor(F.xxhash64("ctx", F.lit(1))).alias("y"))
    groups = variants.groupBy("pair").agg(F.min(F.struct("rep", "ctx")).alias("lead"), same_set.alias("set"), F.max("last").alias("top")).filter("set.kinds > 1 or lead.rep.d <> top")
    live = materialize(variants.join(groups, "pair").select("pair", "ctx", "rep", "set"), "variants")
    tidy(docs.sparkSession)
    # groups of the same contexts are compared once; a large one's contexts are dealt over blocks, of which each two meet
    once = live.filter("set.kinds > 1").groupBy("set").agg(F.min("pair").alias("pair"))
    half = F.when(F.col("set.kinds") <= MANY, 1).otherwise(F.ceil(F.col("set.kinds") / (MANY // 2))).cast("int")
    members = live.join(once.select("pair"), "pair").withColumn("blocks", half).withColumn("block", F.pmod(F.xxhash64("ctx"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    members = members.select("pair", "ctx", "rep", "block", "blocks", other.alias("other")).filter("blocks = 1 or other <> block")
    place = F.least("block", "other") * F.col("blocks") + F.greatest("block", "other")
    cuts = members.select(F.col("rep.d").alias("d"), F.struct("ctx", F.col("rep.c").alias("c"), "pair", place.cast("int").alias("place")).alias("cut"))
    cuts = materialize(cuts, "cuts")
    tidy(docs.sparkSession)
    width_ = 4 * (2 * least - 1)

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = utf8(batch.column(0))
            for i, j in runs(at):
                ids, first = shingle_ids(data[at[i] : at[j]], at[i : j + 1] - at[i], width)
                lists = batch.column(1).slice(i, j - i)
                cuts = lists.flatten()
                row = np.repeat(np.arange(j - i), lists.value_lengths().to_numpy())
                c = cuts.field("c").to_numpy().astype(np.int64) + first[row]
                for k in range(0, len(row), _FLUSH_ROWS):
                    some = slice(k, k + _FLUSH_ROWS)
                    matrix = around(ids, first[row[some]], c[some], first[row[some] + 1], least)
                    part = pa.Array.from_buffers(pa.binary(), len(matrix), [None, pa.py_buffer(np.arange(len(matrix) + 1, dtype=np.int32) * width_), pa.py_buffer(matrix.tobytes())])
                    own = cuts.slice(k, len(matrix))
                    yield pa.RecordBatch.from_arrays([own.field("pair"), own.field("place"), batch.column(2).take(pa.array(row[some] + i)), own.field("ctx"), part], names=["pair", "place", "d", "ctx", "part"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _ in whole_groups(batches, rows=_FLUSH_ROWS):
            yield group_links(rows, least, similarity)

    near_parts = []
    for k in range(PARTS):
        wanted = cuts.filter(F.pmod("cut.pair", F.lit(PARTS)) == k).groupBy("d").agg(F.collect_list("cut").alias("cuts"))
        sources = keyed.select("d", "text").join(wanted, "d").select("text", "cuts", "d")
        parts = sources.mapInArrow(cut_out, "pair long, place int, d long, ctx long, part binary")
        links = parts.repartition("pair", "place").sortWithinPartitions("pair", "place", "d", "ctx").mapInArrow(verify, "x long, y long, shift int, yshift int, xd long, yd long")
        near_parts.append(materialize(links, "near"))
        tidy(docs.sparkSession)
    near = near_parts[0]
    for part in near_parts[1:]:
        near = near.unionByName(part)
    near = materialize(near.dropDuplicates(["x", "y"]), "near")
    drop(cuts, *near_parts)
    # contexts that are in any link: those of several documents, and those verified
    shared = live.groupBy("ctx").agg(F.min("rep").alias("rep"))
    counted = met.groupBy("ctx").agg(F.min("d").alias("a"), F.max("d").alias("b")).filter("a <> b").select("ctx", F.lit(0).alias("shift"), F.lit(True).alias("whole"))
    marks = counted.union(near.select("x", "shift", F.lit(False))).union(near.select("y", "yshift", F.lit(False)))
    marks = marks.groupBy("ctx").agg(F.max("whole").alias("whole"), F.min("shift").alias("low"), F.max("shift").alias("high"))
    # written first, so that rows of a frequent context can be joined in several tasks
    marks = materialize(marks.join(shared.select("ctx", F.col("rep.d").alias("rep")), "ctx"), "marks")
    tidy(docs.sparkSession)
    hits = materialize(met.select("d", "c", "ctx", "e").join(marks, "ctx"), "hits")
    drop(met, live, marks)
    tidy(docs.sparkSession)
    edges = hits.select(F.col("d").alias("a"), F.col("rep").alias("b")).union(near.select("xd", "yd")).filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = materialize(edges, "links")
    roots = components(edges)
    degree = edges.select("a").union(edges.select("b")).groupBy("a").agg(F.count("*").alias("n_links")).withColumnRenamed("a", "d")
    from_ = F.when(F.col("whole"), F.greatest(F.col("c") - least + 1, F.lit(0))).otherwise(F.col("c") - F.col("high"))
    to = F.when(F.col("whole"), F.col("e") + width - 1).otherwise(F.col("c") - F.col("low") + words)
    spans = hits.groupBy("d").agg(F.collect_set(F.struct(from_.alias("from"), to.alias("to"))).alias("spans"))

    base = keyed.select("doc_id", "d")
    named = base.join(roots.withColumnRenamed("node", "d"), "d").groupBy("root").agg(F.min("doc_id").alias("class_id")).join(roots, "root").select(F.col("node").alias("d"), "class_id")
    named = materialize(named.join(degree, "d").join(spans, "d", "left"), "named")

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, texts = [], []
            for value in batch.column(3):
                merged: list[list[int]] = []
                for s in sorted((s["from"], s["to"]) for s in value.as_py() or ()):
                    if merged and s[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s[1])
                    else:
                        merged.append(list(s))
                counts.append(len(merged))
                texts.append(",".join(f"{a}-{b}" for a, b in merged))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(counts, pa.int64()), pa.array(texts, pa.string())], names=[x.split()[0] for x in RESULT.split(", ")])

    rows = base.join(named, "d", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "spans")
    return rows.mapInArrow(unite, RESULT)


def _odd_powers(n: int) -> np.ndarray:
    from .text import _power_tables

    return _power_tables(n + 1)[0][:n]


def _inverse_powers(n: int) -> np.ndarray:
    from .text import _power_tables

    return _power_tables(n + 1)[1]


def op10_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_passages(table(spark, sf_dir, "documents"))
