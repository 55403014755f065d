"""Mixing sources to target weights by subset sums over exact lengths."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import materialize, table

WEIGHTS = (1.0, 2.0, 3.0)
MOST_REPEATS = 3
SEED = 20240607
#: Parts of the seeded order within a length, so that no task ranks all documents of one length.
SALTS = 16
#: Remaining budget in words up to which the exact subset sum runs; shares of each length come before it.
EXACT_WORDS = 1 << 16

_WORDS = r"[^\x20\x09-\x0D]+"


def word_count(text):
    """Words in a text column; null has none."""
    parts = F.split(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+")
    # an empty part can only stand at either end
    ends = F.when(parts[0] == "", 1).otherwise(0) + F.when((F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1).otherwise(0)
    return (F.size(parts) - ends).cast("long")


def targets(sizes: list[int], weights: tuple[float, ...] = WEIGHTS, most: int = MOST_REPEATS) -> list[float]:
    """Shares of the sum of sizes by repeating weights; what is above most x size goes to the others by weight."""
    s = np.array(sizes, float)
    w = np.array([weights[k % len(weights)] for k in range(len(s))], float)
    t, capped = np.zeros(len(s)), np.zeros(len(s), bool)
    while len(s):
        free = ~capped
        left = s.sum() - most * s[capped].sum()
        t[free] = left * w[free] / w[free].sum() if free.any() else 0.0
        over = free & (t > most * s)
        if not over.any():
            break
        capped |= over
        t[capped] = most * s[capped]
    return t.tolist()


def subset_sum(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many of counts[k] items of lengths[k] to take so that their sum is as near to `budget` as can be from below.

    Bounded knapsack over bit sets: counts are split into powers of two, and each newly reached sum keeps its item.
    """
    reached, full = 1, (1 << (budget + 1)) - 1
    item_of = np.full(budget + 1, -1, np.int64)
    items: list[tuple[int, int]] = []
    for k in np.argsort(-lengths, kind="stable"):
        length, left, copies = int(lengths[k]), int(counts[k]), 1
        if length <= 0:
            continue
        left = min(left, budget // length)
        while left:
            copies = min(copies, left)
            new = (reached << (length * copies)) & full & ~reached
            if new:
                bits = np.frombuffer(new.to_bytes(budget // 8 + 1, "little"), np.uint8)
                item_of[np.flatnonzero(np.unpackbits(bits, bitorder="little")[: budget + 1])] = len(items)
                reached |= new
            items.append((int(k), copies))
            left, copies = left - copies, copies * 2
        if reached >> budget & 1:
            break
    taken, at = np.zeros(len(lengths), np.int64), reached.bit_length() - 1
    while at:
        k, copies = items[item_of[at]]
        taken[k] += copies
        at -= int(lengths[k]) * copies
    return taken


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length make up `budget` words: an equal share of each length, rounded down, then
    single documents from the longest down, then the exact subset sum over what is left."""
    lengths, counts = lengths.astype(np.int64), counts.astype(np.int64)
    total = int((lengths * counts).sum())
    if budget >= total:
        return counts.copy()
    taken = np.array([c * budget // total for c in counts.tolist()], np.int64)
    left = budget - int((lengths * taken).sum())
    for k in np.argsort(-lengths, kind="stable"):
        if left <= EXACT_WORDS:
            break
        if lengths[k] > 0:
            more = min(int(counts[k] - taken[k]), max(0, left - EXACT_WORDS // 2) // int(lengths[k]))
            taken[k] += more
            left -= more * int(lengths[k])
    if left > EXACT_WORDS:  # only documents longer than that are left
        for k in np.argsort(lengths, kind="stable"):
            if lengths[k] > 0 and left > EXACT_WORDS:
                more = min(int(counts[k] - taken[k]), left // int(lengths[k]))
                taken[k] += more
                left -= more * int(lengths[k])
    return taken + subset_sum(lengths, counts - taken, min(left, EXACT_WORDS))


def mix_sources(docs: DataFrame, seed: int = SEED, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_REPEATS, carry: list[str] | None = None) -> DataFrame:
    """doc_id, size, source_size, target and taken (words of the mix) for each document.

    Sources are ordered by code point with null last, and weigh `weights` in turn. Each document is taken whole,
    floor(target / source_size) times or once more; documents of one length are ordered by a seeded hash. Null text
    has no words and is taken 0 words of. Repeated rows count as documents of their own. A source's state is its
    histogram of lengths; the driver sees one row for each source. carry: further columns of docs to return.
    """
    spark = docs.sparkSession
    sized = materialize(
        docs.select("doc_id", *(carry or []), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"), F.xxhash64(F.lit(seed), "doc_id", "text").alias("draw")).withColumn("salt", F.pmod("draw", F.lit(SALTS)).cast("int")),
        "sizes",
    )
    by_bucket = sized.groupBy("source", "size", "salt").agg(F.count("*").alias("n"))
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size")).collect()
    totals.sort(key=lambda r: (r[0] is None, (r[0] or "").encode("utf-8", "surrogatepass")))
    goals = targets([r[1] for r in totals], weights, most)
    goal = spark.createDataFrame([(r[0], r[1], t) for r, t in zip(totals, goals, strict=True)], "source string, source_size long, target double")

    def plan(group: pd.DataFrame) -> pd.DataFrame:
        size, target = int(group.source_size.iloc[0]), float(group.target.iloc[0])
        whole = min(most, int(target // size)) if size else 0
        of_length = group.groupby("size", as_index=False)["n"].sum()
        budget = int(round(target)) - whole * size if whole < most else 0
        more = fit_budget(of_length["size"].to_numpy(), of_length["n"].to_numpy(), max(0, budget))
        left = dict(zip(of_length["size"], more, strict=True))
        group = group.sort_values(["size", "salt"])
        before = group.groupby("size")["n"].cumsum() - group["n"]
        group["whole"] = whole
        group["chosen"] = np.clip(group["size"].map(left).to_numpy() - before.to_numpy(), 0, group["n"].to_numpy())
        return group[["source", "size", "salt", "source_size", "target", "whole", "chosen"]]

    key = F.coalesce(F.col("source"), F.lit("")), F.col("source").isNull()
    planned = (
        by_bucket.join(goal, by_bucket.source.eqNullSafe(goal.source)).drop(goal.source)
        .groupBy("source").applyInPandas(plan, "source string, size long, salt int, source_size long, target double, whole long, chosen long")
    )
    order = Window.partitionBy("source", "size", "salt").orderBy("draw", "doc_id")
    ranked = sized.withColumn("number", F.row_number().over(order))
    named = [*(c.alias(n) for c, n in zip(key, ("k_source", "k_null"), strict=True))]
    joined = ranked.select("*", *named).join(planned.select(*named, "size", "salt", "source_size", "target", "whole", "chosen"), ["k_source", "k_null", "size", "salt"])
    return joined.select("doc_id", *(carry or []), "size", "source_size", "target", (F.col("size") * (F.col("whole") + F.when(F.col("number") <= F.col("chosen"), 1).otherwise(0))).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, seed: int = SEED, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """documents as often as mix_sources() takes them, all columns kept whatever they are called; documents without
    words, which cost nothing, stay once. Equal rows share evenly what is taken of them. Texts of any length are counted
    whole; an empty table gives an empty one."""
    kinds = [c for c, kind in docs.dtypes if not kind.startswith(("map", "variant"))]
    own = "_mix"
    while any(c.lower().startswith(own) for c in docs.columns):
        own = f"_{own}"
    key = [f"{own}_k1", f"{own}_k2"]
    hashed = docs.withColumn(key[0], F.xxhash64(*kinds)).withColumn(key[1], F.hash(*kinds))
    taken = mix_sources(hashed, seed, weights, most, carry=key)
    each = F.when(F.col("size") > 0, (F.col("taken") / F.col("size")).cast("int")).otherwise(1)
    times = taken.groupBy(*key).agg(F.sum(each).cast("int").alias(f"{own}_times"), F.count("*").cast("int").alias(f"{own}_rows"))
    number = F.row_number().over(Window.partitionBy(*key).orderBy(key[0])) - 1
    joined = hashed.join(times.filter(F.col(f"{own}_times") > 0), key).withColumn(f"{own}_number", number)
    share = F.floor(F.col(f"{own}_times") / F.col(f"{own}_rows")) + F.when(F.col(f"{own}_number") < F.col(f"{own}_times") % F.col(f"{own}_rows"), 1).otherwise(0)
    copies = joined.filter(share > 0).withColumn(f"{own}_copy", F.explode(F.sequence(F.lit(1), share.cast("int"))))
    return copies.select(*docs.columns)


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))
