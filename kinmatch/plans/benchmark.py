"""A benchmark drawn from the full files: a stratified sample split in two, its truth, and targets with distractors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.normalize import canonical_country
from ..operators import sampling
from ..sources import tables
from ..sources.staging import staged


def write_benchmark(spark: SparkSession, sources: dict[str, str], truth_path: str, out: str, quotas: dict[tuple[str, bool], int] | None = None, share: float = 0.05, cap: int = 25_000) -> DataFrame:
    """Writes train/ and val/ (source1 and ground truth) and benchmark_source2 and 3 under out; lines are as they were.
    sources: paths by S1, S2 and S3. Returns the sample with its split."""
    truth = tables.read_truth(spark, truth_path)
    pairs = truth.select("source1_entity_id", F.explode("matched_ids").alias("matched_id"))
    s1 = tables.read_records(spark, sources["S1"]).withColumn("country", canonical_country(F.col("country")))
    sample = staged(sampling.stratified_sample(sampling.strata(s1, pairs), quotas).select("entity_id", "country", "singleton", "split"))
    targets = [tables.read_records(spark, sources[s]).select("entity_id") for s in ("S2", "S3")]
    pool = staged(sampling.target_pool(targets[0].unionByName(targets[1]), sample, pairs, share, cap))
    for split in ("train", "val"):
        ids = sample.filter(F.col("split") == split).select("entity_id")
        tables.filter_lines(spark, sources["S1"], ids, f"{out}/{split}/{split}_source1.tsv")
        lists = ids.join(truth.select(F.col("source1_entity_id").alias("entity_id"), F.array_join("matched_ids", ",").alias("m")).dropDuplicates(["entity_id"]), "entity_id", "left")
        rows = lists.select(F.col("entity_id").alias("source1_entity_id"), F.coalesce("m", F.lit("")).alias("matched_entity_ids"))
        tables.write_single(rows.withColumn("_at", F.col("source1_entity_id")), f"{out}/{split}/{split}_ground_truth.tsv", "_at")
    for k in (2, 3):
        tables.filter_lines(spark, sources[f"S{k}"], pool, f"{out}/benchmark_source{k}.tsv")
    return sample
