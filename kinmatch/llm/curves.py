"""Approximate nearest neighbours on shifted space-filling curves.

Each curve projects the vectors by its own random rotation, shifts them, and orders them along a Hilbert curve. A
query meets the vectors within its window of each order; what several curves find is merged and ranked by the exact
measure. Orders are cut into blocks of bounded size by key ranges; a query visits all blocks its window touches.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import materialize, table

CURVES = 16
DIMENSIONS = 8
LEVELS = 8
#: Share of all vectors in a query's window of one curve.
WINDOW = 0.08
NEAREST = 5
EVERY = 50
#: Vectors, drawn by hash, on which scales and key ranges are fitted at most.
SAMPLE = 20_000
#: Vectors in a block, about.
BLOCK = 4096
SEED = 20240607


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places along the Hilbert curve of points with coordinates below 2**bits; dimensions x bits are at most 64.

    Gray-code construction: from the highest bit down, each coordinate reflects or swaps the lower bits of the first.
    """
    x = cells.astype(np.int64).copy()
    n = x.shape[1]
    for bit in range(bits - 1, 0, -1):
        q, low = 1 << bit, (1 << bit) - 1
        for k in range(n):
            set_ = (x[:, k] & q) > 0
            swap = np.where(set_, 0, (x[:, 0] ^ x[:, k]) & low)
            x[:, 0] ^= np.where(set_, low, swap)
            x[:, k] ^= swap
    for k in range(1, n):
        x[:, k] ^= x[:, k - 1]
    flip = np.zeros(len(x), np.int64)
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where((x[:, n - 1] >> bit) & 1 > 0, (1 << bit) - 1, 0)
    x ^= flip[:, None]
    key = np.zeros(len(x), np.uint64)
    for bit in range(bits - 1, -1, -1):
        for k in range(n):
            key = (key << np.uint64(1)) | ((x[:, k] >> bit) & 1).astype(np.uint64)
    return key


@dataclass
class Curve:
    rotation: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    shift: np.ndarray
    cuts: np.ndarray

    def keys(self, unit: np.ndarray) -> np.ndarray:
        y = ((unit @ self.rotation) - self.centre) / self.scale
        return hilbert_keys(np.clip((y + 3 + self.shift) / 6.5 * (1 << LEVELS), 0, (1 << LEVELS) - 1).astype(np.int64), LEVELS)


def fit_curves(sample: np.ndarray, blocks: int, curves: int, seed: int = SEED) -> list[Curve]:
    """sample: unit vectors. Cuts part each order into `blocks` ranges of about as many vectors."""
    rng = np.random.default_rng(seed)
    dimensions = sample.shape[1]
    out = []
    for _ in range(curves):
        rotation = np.linalg.qr(rng.standard_normal((dimensions, dimensions)))[0][:, : min(DIMENSIONS, dimensions)]
        y = sample @ rotation
        curve = Curve(rotation, y.mean(axis=0), np.maximum(y.std(axis=0), 1e-9), rng.random(y.shape[1]) * 0.5, np.zeros(0, np.uint64))
        keys = np.sort(curve.keys(sample))
        curve.cuts = keys[(np.arange(1, blocks) * len(keys) // blocks)]
        out.append(curve)
    return out


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    values = np.concatenate([np.frombuffer(x.as_buffer(), np.float64) for x in column]) if len(column) else np.zeros(0)
    return values.reshape(-1, dimensions)


def nearest(rows: DataFrame, every: int = EVERY, nearest: int = NEAREST, curves: int = CURVES, window: float = WINDOW, seed: int = SEED) -> DataFrame:
    """query_id, rank, vec_id and score (cosine) of each query's `nearest` found; queries have vec_id divisible by
    `every`, candidates are all other rows.

    Null, zero and non-finite vectors, rows with null vec_id, and vectors of another size than most (the larger on
    a tie) take no part. Equal vectors are searched once and stand for their smallest ids, of which `nearest` and
    one for the query itself can matter; equal (vec_id, vector) rows count once. Ties go to the smaller vec_id. Fewer
    candidates give fewer rows, an empty table none. Models are fitted on at most SAMPLE vectors; all are indexed.
    """
    spark = rows.sparkSession
    vector = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = rows.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("v")).filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)).filter(finite & F.exists("v", lambda x: x != 0))
    sizes = valid.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return spark.createDataFrame([], schema)
    d = sizes[0]
    # -0.0 and 0.0 are one value
    valid = valid.filter(F.size("v") == d).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0))).withColumn("k1", F.xxhash64("v")).withColumn("k2", F.hash("v"))
    keyed = valid.dropDuplicates(["vec_id", "k1", "k2"])
    order = Window.partitionBy("k1", "k2").orderBy("vec_id")
    members = keyed.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= nearest + 1)
    queries = keyed.filter(F.col("vec_id") % every == 0).select("vec_id", "k1", "k2")
    asks = queries.select("k1", "k2").distinct().withColumn("ask", F.lit(True))
    points = members.groupBy("k1", "k2").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.first("v").alias("v")).join(asks, ["k1", "k2"], "left")
    raw = materialize(points.select("k1", "k2", "ids", F.coalesce("ask", F.lit(False)).alias("ask"), "v"), "points")
    n = raw.count()
    drawn = raw.select("v", F.xxhash64(F.lit(seed), "k1", "k2").alias("draw")).orderBy("draw").limit(SAMPLE).toPandas()
    sample = np.array(drawn["v"].tolist(), float)
    blocks = int(min(max(1, -(-n // BLOCK)), max(1, len(sample) // 8)))
    salts = max(1, -(-n // (blocks * 2 * BLOCK)))
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    # finer ranges say where a query's window ends
    fine = max(1, min(len(sample) // 8, 512))
    shared = spark.sparkContext.broadcast((fit_curves(unit, blocks, curves, seed), fit_curves(unit, fine, curves, seed)))
    reach = math.ceil(window * fine / 2)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coarse, fines = shared.value
        for batch in batches:
            v = np.asarray(batch.column(4).flatten()).reshape(-1, d)
            u = v / np.linalg.norm(v, axis=1, keepdims=True)
            data = pa.array([x.tobytes() for x in v], pa.binary())
            k1, ask = batch.column(0).to_numpy(), batch.column(3).to_numpy(zero_copy_only=False)
            asking = np.flatnonzero(ask)
            for c, (curve, fine_curve) in enumerate(zip(coarse, fines, strict=True)):
                keys = curve.keys(u)
                cell = np.searchsorted(curve.cuts, keys, side="right")
                part = cell * salts + (k1 & 0x7FFFFFFF) % salts
                rows_, parts, is_query = [np.arange(len(v))], [part], [np.zeros(len(v), bool)]
                # the blocks between the window's ends, all salts of them
                at = np.searchsorted(fine_curve.cuts, keys[asking], side="right")
                low = np.where(at - reach > 0, np.searchsorted(curve.cuts, fine_curve.cuts[np.clip(at - reach - 1, 0, None)], side="right") if len(fine_curve.cuts) else 0, 0)
                high = np.where(at + reach < len(fine_curve.cuts), np.searchsorted(curve.cuts, fine_curve.cuts[np.clip(at + reach, None, len(fine_curve.cuts) - 1)], side="right") if len(fine_curve.cuts) else 0, len(curve.cuts))
                span = (high - low + 1) * salts
                rows_.append(np.repeat(asking, span))
                parts.append(np.repeat(low * salts - (np.cumsum(span) - span), span) + np.arange(int(span.sum())))
                is_query.append(np.ones(int(span.sum()), bool))
                take = pa.array(np.concatenate(rows_))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(take), c, np.int32)), pa.array(np.concatenate(parts).astype(np.int64)), pa.array(np.concatenate(is_query)), batch.column(0).take(take), batch.column(1).take(take), batch.column(2).take(take), data.take(take)],
                    names=["curve", "part", "is_query", "k1", "k2", "ids", "v"],
                )

    dealt = raw.mapInArrow(deal, "curve int, part long, is_query boolean, k1 long, k2 int, ids array<long>, v binary")

    def rank(group: pa.Table) -> pa.Table:
        asks_ = group["is_query"].to_numpy()
        names = ["k1", "k2", "ids", "score"]
        types = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.float64()]
        out: list[pa.Table] = []
        if asks_.any() and not asks_.all():
            at, to = np.flatnonzero(asks_), np.flatnonzero(~asks_)
            all_ = _matrix(group["v"].combine_chunks(), d)
            norms = np.sqrt((all_ * all_).sum(axis=1))
            points_, ids = all_[to] / norms[to][:, None], group["ids"].take(pa.array(to))
            for a in range(0, len(at), 256):
                q = at[a : a + 256]
                near = (all_[q] / norms[q][:, None]) @ points_.T
                k = min(nearest + 1, len(to))
                kth = np.partition(near, len(to) - k, axis=1)[:, len(to) - k]
                row, col = np.nonzero(near >= kth[:, None] - 1e-12)  # ties too
                x, y = all_[q[row]], all_[to[col]]
                score = (x * y).sum(axis=1) / (norms[q[row]] * norms[to[col]])
                which = pa.array(q[row])
                out.append(pa.table([group["k1"].take(which), group["k2"].take(which), ids.take(pa.array(col)), pa.array(score)], names=names))
        return pa.concat_tables(out) if out else pa.table([pa.array([], t) for t in types], names=names)

    found = dealt.groupBy("curve", "part").applyInArrow(rank, "k1 long, k2 int, ids array<long>, score double")
    flat = found.select("k1", "k2", "score", F.explode("ids").alias("vec_id")).groupBy("k1", "k2", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("k1", "k2").orderBy(F.desc("score"), "vec_id")
    few = flat.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= nearest + 1)
    own = queries.select(F.col("vec_id").alias("query_id"), "k1", "k2").join(few, ["k1", "k2"]).filter("query_id <> vec_id")
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return own.withColumn("rank", F.row_number().over(last).cast("int")).filter(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")


def op7_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))
