"""Stratified samples, distractors and profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Sample sizes by (country, whether the record has no match).
QUOTAS = {("US", True): 1674, ("US", False): 28326, ("INDIA", True): 1116, ("INDIA", False): 18884}
TRAIN_SHARE = 0.8


def seeded(key: str = "entity_id", seed: int = 42) -> Column:
    return F.xxhash64(F.lit(seed), key)


def strata(s1: DataFrame, truth: DataFrame) -> DataFrame:
    """Adds singleton: no pair in truth."""
    matched = truth.select(F.col("source1_entity_id").alias("entity_id")).distinct().withColumn("_m", F.lit(True))
    return s1.join(matched, "entity_id", "left").withColumn("singleton", F.col("_m").isNull()).drop("_m")


def stratified_sample(records: DataFrame, quotas: dict[tuple[str, bool], int] | None = None, order: Column | None = None) -> DataFrame:
    """Up to the quota of each (country, singleton), drawn by hash or by `order`; countries without one are left out.
    Adds split: the first 80 % of a country's sample train, the rest validate."""
    wanted = quotas or QUOTAS
    spark = records.sparkSession
    table = spark.createDataFrame([(c, s, n) for (c, s), n in wanted.items()], "country string, singleton boolean, quota int")
    order = seeded() if order is None else order
    drawn = records.join(F.broadcast(table), ["country", "singleton"])
    within = Window.partitionBy("country", "singleton").orderBy(order, "entity_id")
    drawn = drawn.withColumn("_r", F.row_number().over(within)).filter(F.col("_r") <= F.col("quota")).drop("_r", "quota")
    country = Window.partitionBy("country")
    place = F.row_number().over(country.orderBy(order, "entity_id")) - 1
    return drawn.withColumn("_p", place).withColumn("_n", F.count("*").over(country)).withColumn("split", F.when(F.col("_p") < F.floor(F.col("_n") * TRAIN_SHARE), "train").otherwise("val")).drop("_p", "_n")


def target_pool(targets: DataFrame, sampled: DataFrame, truth: DataFrame, share: float = 0.05, cap: int = 25_000, draw: Column | None = None, order: Column | None = None) -> DataFrame:
    """Of each source: all true targets of the sample, and of the others a share drawn by hash, at most `cap` of them.
    Adds is_true."""
    needed = truth.join(sampled.select(F.col("entity_id").alias("source1_entity_id")), "source1_entity_id", "left_semi").select(F.col("matched_id").alias("entity_id")).distinct().withColumn("_t", F.lit(True))
    marked = targets.join(needed, "entity_id", "left").withColumn("is_true", F.col("_t").isNotNull()).drop("_t").withColumn("_s", F.split("entity_id", "-")[0])
    drawn = F.pmod(seeded(), F.lit(10_000)) < int(share * 10_000) if draw is None else draw
    order = seeded(seed=43) if order is None else order
    others = marked.filter(~F.col("is_true") & drawn).withColumn("_r", F.row_number().over(Window.partitionBy("_s").orderBy(order, "entity_id"))).filter(F.col("_r") <= cap)
    return marked.filter("is_true").drop("_s").unionByName(others.drop("_s", "_r"))


def uniform_sample(records: DataFrame, n: int = 5000, seed: int = 42, order: Column | None = None) -> DataFrame:
    """n records, drawn by hash or by `order`."""
    return records.orderBy(seeded(seed=seed) if order is None else order, "entity_id").limit(n)


def null_profile(records: DataFrame) -> DataFrame:
    """(column_name, n_rows, n_null) for every column, in one pass."""
    counts = records.agg(F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in records.columns])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col("n").alias("n_rows"), F.col(c).alias("n_null")) for c in records.columns])).alias("x")).select("x.*")


def cross_country(s1: DataFrame, targets: DataFrame, truth: DataFrame) -> DataFrame:
    """True pairs whose records are of different countries. Pairs without a record on either side aren't counted."""
    a = s1.select(F.col("entity_id").alias("source1_entity_id"), F.col("country").alias("country_s1"))
    b = targets.select(F.col("entity_id").alias("matched_id"), F.col("country").alias("country_cand"))
    return truth.join(a, "source1_entity_id").join(b, "matched_id").filter(F.col("country_s1") != F.col("country_cand"))
