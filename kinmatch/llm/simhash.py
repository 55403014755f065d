"""SimHash near-dedup over a vantage-point tree of fingerprints."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .graph import components
from .groups import pairs_within, whole_groups
from .store import materialize, table
from .text import Words, mix, ragged, runs, utf8

RADIUS = 2
#: Levels of the tree at most.
MOST_LEVELS = 7
#: Cost of a probe, in comparisons of two fingerprints: it is shuffled and sorted.
PROBE_COST = 150


def shingle_hashes(data: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 (seed 42) of each run of `width` words joined by spaces, and how many each text has. A text of fewer
    words has one shingle of them all; one without words has none."""
    words = Words(data, at)
    lengths = words.ends - words.starts
    ends = np.cumsum(lengths + 1)
    flat = np.full(int(ends[-1]) if len(ends) else 0, 0x20, np.uint8)
    starts = ends - lengths - 1
    flat[ragged(starts, lengths)] = words.low[ragged(words.starts, lengths)]
    n = np.diff(words.first)
    shingles = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    from_ = ragged(words.first[:-1], shingles)
    to = from_ + np.repeat(np.minimum(n, width), shingles) - 1
    raw = flat.tobytes()
    a, b = starts[from_].tolist(), (ends[to] - 1).tolist()
    return np.array([xxh64_intdigest(raw[x:y], 42) for x, y in zip(a, b, strict=True)], np.uint64), shingles


_LANES = np.uint64(0x0101010101010101)


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A fingerprint for each group of hashes: bit set if over half the group has it. Eight byte lanes of a word
    count eight bits at once, in blocks of at most 255 hashes."""
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    n = counts[full]
    group_at = np.cumsum(n) - n
    blocks = -(-n // 255)
    block_first = np.cumsum(blocks) - blocks
    block_at = np.repeat(group_at, blocks) + (np.arange(int(blocks.sum())) - np.repeat(block_first, blocks)) * 255
    for bit in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(bit)) & _LANES, block_at)
        sums = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), block_first, axis=0)
        high = (2 * sums > n[:, None]).astype(np.uint64)
        out[full] |= (high << (np.arange(8, dtype=np.uint64) * np.uint64(8) + np.uint64(bit))).sum(axis=1, dtype=np.uint64)
    return out


def fingerprints(docs: DataFrame, width: int) -> DataFrame:
    """doc_id and fp (64 bits as a long) for each row; whole texts, null as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = utf8(batch.column(1))
            out = [np.zeros(0, np.uint64)]
            for i, j in runs(at):
                out.append(majority(*shingle_hashes(data[at[i] : at[j]], at[i : j + 1] - at[i], width)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(out).view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp long")


def vantage_points(levels: int) -> list[int]:
    """A point for each level, by hash; signed."""
    points = [xxh64_intdigest(b"vantage %d" % k, 42) for k in range(levels)]
    return [p - (1 << 64) if p >> 63 else p for p in points]


def ring_steps(levels: int, radius: int) -> list[tuple[int, ...]]:
    """Ring changes, one for each level, that a point within `radius` can show: each differing bit moves every
    distance by one, so that by the triangle bound none changes by more than the radius, and all have its parity.
    One of each pair of opposite steps is kept, as pairs are met from either side."""
    steps = set()
    for d in range(radius + 1):
        steps.update(itertools.product(range(-d, d + 1, 2), repeat=levels))
    return sorted(s for s in steps if s >= tuple(-x for x in s))


def tree_levels(n: int, radius: int = RADIUS) -> int:
    """The depth at which n points cost least: more levels mean more probes of smaller leaves. The first level's
    rings hold about 1/14 of spread-out points each; further ones have half as many rings that differ in parity."""

    def cost(levels: int) -> float:
        probes = len(ring_steps(levels, radius))
        return probes * (PROBE_COST + n / (14 * 7 ** (levels - 1)))

    return min(range(2, MOST_LEVELS + 1), key=cost)


def near_pairs(points: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): all pairs of different fingerprints of points (fp long, distinct) that differ in at most `radius` bits.

    A vantage-point tree in which all nodes of a level share their vantage point, and a node has a branch for each
    distance to it. Its leaves are shards, named by the distances on the way down. A point looks into those leaves
    that the triangle bound leaves: its own, and the neighbours whose rings reach over a boundary. Shards are
    met by a sort-merge join, so their size isn't bound by memory and hot ones can be split.
    """
    levels = tree_levels(points.count(), radius)
    rings = [F.bit_count(F.col("fp").bitwiseXOR(F.lit(p))).cast("int") for p in vantage_points(levels)]
    steps = ring_steps(levels, radius)
    shard = lambda ds: sum((d * F.lit(1 << (8 * k)).cast("long") for k, d in enumerate(ds)), F.lit(0).cast("long"))
    base = points.select("fp", shard(rings).alias("leaf"))
    # a step changes the leaf's number by the same sum everywhere
    moves = [sum(s << (8 * k) for k, s in enumerate(step)) for step in steps]
    probes = base.select(F.col("fp").alias("b"), F.explode(F.array(*[F.lit(m).cast("long") for m in moves])).alias("move"), "leaf").select("b", "move", (F.col("leaf") + F.col("move")).alias("leaf"))
    left = base.select(F.col("fp").alias("a"), "leaf").hint("merge")
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    once = (F.col("move") != 0) | (F.col("a") < F.col("b"))
    return left.join(probes, (left.leaf == probes.leaf) & close & once).select("a", "b")


def near_duplicates(docs: DataFrame, width: int = 3, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (smallest doc_id reachable over fingerprints that differ
    in at most `radius` bits) for each row.

    Documents without words have fingerprint zero and link like others. Copies share a fingerprint, which is
    compared once. Rows with null doc_id take part; their component_id is null only where no other row is in it.
    Repeated rows are kept; other columns are not read; an empty table gives an empty one.
    """
    fps = materialize(fingerprints(docs, width), "fingerprints")
    distinct = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    linked = materialize(components(near_pairs(distinct.select("fp"), radius)), "components")
    roots = distinct.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    named = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = materialize(roots.join(named, "root").select("fp", "component_id"), "classes")
    return fps.join(classes, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: Words of 64 bits in the fingerprints of near_groups().
WIDE = 8
#: Standard deviations by which bits of texts to be compared may differ beyond the expected ones.
DEVIATIONS = 4
#: Shards that each text is in, and least shingles that texts of a shard have in common. Of texts at similarity 0.8 all
#: but 2 in 10,000 meet in one.
SHARDS, AGREE = 12, 3
#: Texts that are compared in one place; of larger shards each two blocks of half as many meet in a place.
BLOCK = 4096
#: Texts of a shard of which all pairs are compared together with those of other shards.
FEW = 64
_LEAST = np.random.default_rng(20240610).integers(1, 2**63, SHARDS * AGREE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(data: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's runs of `width` words, in order without repeats, and how many it has. A text of fewer words
    has one of them all; one without words has none."""
    words = Words(data, at)
    h = words.hashes().view(np.uint64)
    n = np.diff(words.first)
    count = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    text = np.repeat(np.arange(len(n)), count)
    from_, length = ragged(words.first[:-1], count), np.minimum(n, width)[text]
    hashes = np.zeros(len(from_), np.uint64)
    for k in range(width):
        on = slice(None) if (length > k).all() else np.flatnonzero(length > k)
        hashes[on] = mix(hashes[on] + h[from_[on] + k] + np.uint64(k + 1))
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    keep = np.ones(len(hashes), bool)
    keep[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    return hashes[keep], np.bincount(text[keep], minlength=len(n)).astype(np.int64)


def shards(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A row of SHARDS keys for each text: each of AGREE shingles that are least by some order."""
    out = np.zeros((len(counts), SHARDS), np.uint64)
    full = np.flatnonzero(counts)
    first = (np.cumsum(counts) - counts)[full]
    for k, odd in enumerate(_LEAST):
        if len(full):
            out[full, k // AGREE] = mix(out[full, k // AGREE] + np.minimum.reduceat(hashes * odd, first) + np.uint64(k))
    return out


def wide_fingerprints(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, node (the text's hash; 0 without words), n (different shingles), fps (WIDE fingerprints of 64 bits of
    those, each by another mix of their hashes), keys (its shards)."""
    seeds = np.arange(1, WIDE, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = utf8(batch.column(1))
            out, counts, keys = [np.zeros((0, WIDE), np.uint64)], [np.zeros(0, np.int64)], [np.zeros((0, SHARDS), np.uint64)]
            for i, j in runs(at, 1 << 18):
                hashes, n = shingle_sets(data[at[i] : at[j]], at[i : j + 1] - at[i], width)
                out.append(np.column_stack([majority(hashes, n), *(majority(mix(hashes ^ seed), n) for seed in seeds)]))
                counts.append(n)
                keys.append(shards(hashes, n))
            n = np.concatenate(counts)
            lists = lambda x: pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * x.shape[1]), pa.array(x.view(np.int64).ravel()))
            node = pa.array(np.where(n > 0, batch.column(2).to_numpy(), 0))
            yield pa.RecordBatch.from_arrays([batch.column(0), node, pa.array(n), lists(np.concatenate(out)), lists(np.concatenate(keys))], names=["doc_id", "node", "n", "fps", "keys"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), text_hash()).mapInArrow(run, "doc_id long, node long, n long, fps array<long>, keys array<long>")


def text_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("node")


def by_centre(fps: np.ndarray) -> np.ndarray:
    """Rows of fingerprints, the nearest to their majority first: of copies with changes of their own that is the text
    which all others are near to."""
    bits = np.unpackbits(fps.view(np.uint8), axis=1)
    centre = 2 * bits.sum(axis=0, dtype=np.int64) > len(fps)
    return np.argsort((bits != centre).sum(axis=1), kind="stable")


def near_links(fps: np.ndarray, n: np.ndarray, limit: int, similarity: float, mine: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between fingerprints that differ in at most `limit` bits and sizes n that allow
    `similarity`. mine: rows of one of two blocks; rows of the other are compared with these alone.

    The first row is a vantage point: rows whose distances to it differ by more than `limit` can't be near. Each row
    reached looks at all rows left that this bound leaves.
    """
    order = by_centre(fps)
    ring = np.bitwise_count(fps ^ fps[order[0]]).sum(axis=1, dtype=np.int64)
    left = order
    found: list[tuple[np.ndarray, np.ndarray]] = []
    queue: list[int] = []
    while len(left):
        if not queue:
            queue.append(int(left[0]))
            left = left[1:]
        k = queue.pop()
        close = left[(np.abs(ring[left] - ring[k]) <= limit) & (np.minimum(n[left], n[k]) >= similarity * np.maximum(n[left], n[k]) - 1e-9)]
        if mine is not None:
            close = close[mine[close] != mine[k]]
        close = close[np.bitwise_count(fps[close] ^ fps[k]).sum(axis=1, dtype=np.int64) <= limit]
        if len(close):
            found.append((np.full(len(close), k), close))
            queue += close.tolist()
            reached = np.zeros(len(fps), bool)
            reached[close] = True
            left = left[~reached[left]]
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2


def exact_links(hashes: np.ndarray, counts: np.ndarray, order: np.ndarray, similarity: float, mine: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between sets (ordered hashes one after the other) of Jaccard similarity at least
    `similarity`: each set reached looks at all that are not, as near_links() does."""
    first = np.cumsum(counts) - counts
    left = order
    found: list[tuple[np.ndarray, np.ndarray]] = []
    queue: list[int] = []
    while len(left):
        if not queue:
            queue.append(int(left[0]))
            left = left[1:]
        k = queue.pop()
        own = hashes[first[k] : first[k] + counts[k]]
        close = left[np.minimum(counts[left], len(own)) >= similarity * np.maximum(counts[left], len(own)) - 1e-9]
        if mine is not None:
            close = close[mine[close] != mine[k]]
        if not len(close):
            continue
        if len(own):
            flat = hashes[ragged(first[close], counts[close])]
            both = own[np.minimum(np.searchsorted(own, flat), len(own) - 1)] == flat
            common = np.add.reduceat(both, np.cumsum(counts[close]) - counts[close], dtype=np.int64)
            close = close[common >= similarity * (counts[close] + len(own) - common) - 1e-9]
        found.append((np.full(len(close), k), close))
        queue += close.tolist()
        reached = np.zeros(len(counts), bool)
        reached[close] = True
        left = left[~reached[left]]
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2


def spanning(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least node reachable from each of n nodes over edges a-b."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        while (new != new[new]).any():
            new = new[new]
        if (new == root).all():
            break
        root = new[root]
        keep = root[a] != root[b]
        a, b = a[keep], b[keep]
    return root


def in_blocks(members: DataFrame, key: str, block: int = 0) -> DataFrame:
    """Adds place and side to rows of (key, node, ...): groups of up to BLOCK rows are one place; of larger ones rows
    are dealt over blocks of half as many, and each two blocks meet in a place."""
    most = block or BLOCK
    sizes = members.groupBy(key).agg(F.count("*").alias("_n")).filter("_n > 1")
    blocks = F.when(F.col("_n") <= most, 1).otherwise(F.ceil(F.col("_n") / (most // 2))).cast("int")
    dealt = members.join(sizes, key).withColumn("_blocks", blocks).withColumn("side", F.pmod(F.xxhash64("node", key), F.col("_blocks")).cast("int"))
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    place = F.least("side", "_other").cast("long") * F.col("_blocks") + F.greatest("side", "_other")
    return dealt.withColumn("place", F.when(F.col("_blocks") > 1, place).otherwise(F.lit(-1))).drop("_n", "_blocks", "_other")


def near_groups(docs: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """doc_id and component_id, as near_duplicates() has them, for texts whose sets of shingles have a Jaccard similarity of
    `similarity` or more.

    At such a radius (of two texts with Jaccard similarity J a bit of their fingerprints differs with probability
    acos(2J / (1 + J)) / pi) the rings of a vantage point that all texts share overlap and prune nothing. So the tree's
    upper levels are shards of texts that have AGREE least shingles in common, and a vantage point parts each shard:
    within it fingerprints of 64 x WIDE bits within DEVIATIONS of the expected distance are candidates. What these
    join is compared exactly, shingles with shingles. Places return spanning forests of links, not all links.
    """
    fps = materialize(wide_fingerprints(docs, width), "wide")
    nodes = materialize(fps.groupBy("node").agg(F.first("fps").alias("fps"), F.first("keys").alias("keys"), F.min("n").alias("n"), F.min("doc_id").alias("least")), "nodes")
    differs = np.arccos(2 * similarity / (1 + similarity)) / np.pi
    limit = int(differs * 64 * WIDE + DEVIATIONS * np.sqrt(differs * (1 - differs) * 64 * WIDE))
    keyed = nodes.filter("n > 0").select("node", F.posexplode("keys").alias("shard", "key")).select("node", F.xxhash64("shard", "key").alias("key"))
    placed = materialize(in_blocks(keyed, "key").join(nodes.select("node", "fps", "n"), "node"), "placed")

    def sides(side: np.ndarray, place: np.ndarray) -> np.ndarray | None:
        return side if place[0] >= 0 and side.min() != side.max() else None

    def bits(table: pa.Table) -> np.ndarray:
        return table["fps"].chunk(0).flatten().to_numpy().reshape(-1, WIDE).view(np.uint64)

    def edges_of(a: list[np.ndarray], b: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else np.zeros(0, np.int64)) for x in (a, b)], names=["a", "b"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, cut in whole_groups(batches):
            node, n, words, place, side = table["node"].to_numpy(), table["n"].to_numpy(), bits(table), table["place"].to_numpy(), table["side"].to_numpy()
            first, sizes = cut[:-1], np.diff(cut)
            a, b = [], []
            few = (sizes <= FEW) & (place[first] < 0)
            for i, j in pairs_within(first[few], sizes[few], 1 << 16):
                ok = np.minimum(n[i], n[j]) >= similarity * np.maximum(n[i], n[j]) - 1e-9
                i, j = i[ok], j[ok]
                ok = np.bitwise_count(words[i] ^ words[j]).sum(axis=1, dtype=np.int64) <= limit
                a.append(node[i[ok]])
                b.append(node[j[ok]])
            for g in np.flatnonzero(~few):
                x = slice(cut[g], cut[g + 1])
                i, j = near_links(words[x], n[x], limit, similarity, sides(side[x], place[x]))
                a.append(node[x][i])
                b.append(node[x][j])
            yield edges_of(a, b)

    placed_rows = placed.select("key", "place", "side", "node", "n", "fps").repartition("key", "place").sortWithinPartitions("key", "place")
    edges = placed_rows.mapInArrow(compare, "a long, b long").distinct()
    joined = materialize(components(edges), "candidates")
    # large components go by shards again, which hold every near pair
    large = joined.groupBy("root").agg(F.count("*").alias("size")).filter(F.col("size") > BLOCK).select("root")
    small = joined.join(large, "root", "left_anti").select("node", F.col("root").alias("group"), F.lit(-1).cast("long").alias("place"), F.lit(0).alias("side"))
    again = joined.join(large, "root").join(placed.select("node", "key", "place", "side"), "node").select("node", F.xxhash64("root", "key").alias("group"), "place", "side")
    wanted = small.unionByName(again).groupBy("node").agg(F.collect_list(F.struct("group", "place", "side")).alias("at"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = utf8(batch.column(1))
            for i, j in runs(at):
                hashes, n = shingle_sets(data[at[i] : at[j]], at[i : j + 1] - at[i], width)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(hashes.view(np.int64)))
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), part.column(3), lists], names=["node", "fps", "at", "hashes"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, cut in whole_groups(batches, rows=2_000):
            node, words, place, side, lists = table["node"].to_numpy(), bits(table), table["place"].to_numpy(), table["side"].to_numpy(), table["hashes"].chunk(0)
            counts, hashes = np.diff(lists.offsets.to_numpy()).astype(np.int64), lists.flatten().to_numpy().view(np.uint64)
            at = np.concatenate([[0], np.cumsum(counts)])
            a, b = [], []
            for c, e in zip(cut[:-1], cut[1:], strict=True):
                i, j = exact_links(hashes[at[c] : at[e]], counts[c:e], by_centre(words[c:e]), similarity, sides(side[c:e], place[c:e]))
                a.append(node[c:e][i])
                b.append(node[c:e][j])
            yield edges_of(a, b)

    texts = docs.select(text_hash(), F.col("text").cast("string").alias("text")).join(wanted.select("node"), "node", "left_semi").groupBy("node").agg(F.first("text").alias("text"))
    told = texts.join(wanted, "node").join(nodes.select("node", "fps"), "node").select("node", "text", "fps", "at")
    exact = told.mapInArrow(sets, "node long, fps array<long>, at array<struct<group: long, place: long, side: int>>, hashes array<long>").withColumn("at", F.explode("at"))
    exact = exact.select("at.group", "at.place", "at.side", "node", "fps", "hashes").repartition("group", "place").sortWithinPartitions("group", "place").mapInArrow(verify, "a long, b long")
    linked = materialize(components(exact), "components")
    roots = nodes.select("node", "least").join(linked, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "least")
    named = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = materialize(roots.join(named, "root").select("node", "component_id"), "classes")
    return fps.join(classes, "node").select("doc_id", "component_id")


def keep_one(docs: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """documents without those whose near_groups() component has a smaller doc_id; all columns kept whatever they are
    called. Of rows that share the smallest doc_id all stay, as do rows with null doc_id. Texts without words, null
    among them, are copies of each other; long ones are compared whole. An empty table gives an empty one."""
    losers = near_groups(docs, width, similarity).filter("doc_id > component_id").select("doc_id").distinct()
    return docs.join(losers, "doc_id", "left_anti").select(*docs.columns)


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
