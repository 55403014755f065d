"""Two-stage gating, the entity metric and threshold search, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import Gate
from ..sources.tables import joined_ids


def margin(delta: float, min_margin: float | None) -> float:
    """An older name of the margin counts where it is small enough to be one."""
    return min_margin if min_margin is not None and min_margin <= 0.30 else delta


def accepted(scored: DataFrame, gate: Gate, min_margin: float | None = None) -> DataFrame:
    """Pairs that pass: the query's best reaches tau_singleton, the pair tau_match, and lies within delta of the best."""
    best = F.max("predicted_prob").over(Window.partitionBy("source1_entity_id"))
    p = F.col("predicted_prob")
    kept = scored.withColumn("best", best).filter((F.col("best") >= gate.tau_singleton) & (p >= gate.tau_match) & (F.col("best") - p <= margin(gate.delta, min_margin)))
    return kept.groupBy("source1_entity_id", "candidate_entity_id").agg(F.max("predicted_prob").alias("predicted_prob"))


def id_lists(pairs: DataFrame, s1_ids: DataFrame, order: Column, name: str, ids: str = "candidate_entity_id") -> DataFrame:
    """A row for each of s1_ids with its pairs' ids joined by commas; empty for none."""
    lists = pairs.groupBy("source1_entity_id").agg(joined_ids(F.col(ids), order).alias(name))
    every = s1_ids.select(F.col("entity_id").alias("source1_entity_id"))
    return every.join(lists, "source1_entity_id", "left").select("source1_entity_id", F.coalesce(name, F.lit("")).alias(name))


def matching_results(scored: DataFrame, s1_ids: DataFrame, gate: Gate, min_margin: float | None = None) -> DataFrame:
    order = F.struct(-F.col("predicted_prob"), F.col("candidate_entity_id"))
    return id_lists(accepted(scored, gate, min_margin), s1_ids, order, "matched_entity_ids")


def candidate_lists(candidates: DataFrame, s1_ids: DataFrame) -> DataFrame:
    """Candidates of each query in the order of their rank, each once."""
    once = candidates.groupBy("source1_entity_id", "candidate_entity_id").agg(F.min("fused_rank").alias("fused_rank"))
    return id_lists(once, s1_ids, F.struct("fused_rank", "candidate_entity_id"), "candidate_entity_ids")


def f05(hits: Column, predicted: Column, true: Column) -> Column:
    """F0.5 of an entity from counts: 1 if both sides are empty, 0 if one is or nothing hits."""
    p, r = hits / predicted, hits / true
    return F.when((predicted == 0) & (true == 0), 1.0).when((predicted == 0) | (true == 0) | (hits == 0), 0.0).otherwise(1.25 * p * r / (0.25 * p + r))


def entity_scores(predicted: DataFrame, truth: DataFrame, entities: DataFrame) -> DataFrame:
    """Of each entity (source1_entity_id): n_true, n_pred, n_hit and f05. predicted: pairs with candidate_entity_id;
    truth: pairs with matched_id; both count once each."""
    key = "source1_entity_id"
    t = truth.select(key, F.col("matched_id").alias("id")).distinct().withColumn("t", F.lit(1))
    p = predicted.select(key, F.col("candidate_entity_id").alias("id")).distinct().withColumn("p", F.lit(1))
    sums = t.join(p, [key, "id"], "full_outer").groupBy(key).agg(F.count("t").alias("n_true"), F.count("p").alias("n_pred"), F.count_if(F.col("t").isNotNull() & F.col("p").isNotNull()).alias("n_hit"))
    counts = entities.select(key).distinct().join(sums, key, "left").na.fill(0)
    return counts.withColumn("f05", f05(F.col("n_hit"), F.col("n_pred"), F.col("n_true")))


def macro_f05(scores: DataFrame) -> DataFrame:
    return scores.agg(F.coalesce(F.avg("f05"), F.lit(0.0)).alias("macro_f05"), F.count("*").alias("n_entities"))


def threshold_pairs() -> list[tuple[int, int]]:
    """The grid in percent: 45 to 85 and 50 to 90 by 5, tau_match no more than 10 below tau_singleton. Of the pairs
    exactly 10 below, (80, 70) is out: in binary floating point 0.8 - 0.1 is greater than 0.7."""
    return [(s, m) for s in range(45, 90, 5) for m in range(50, 95, 5) if m >= s - 10 and (s, m) != (80, 70)]


def trials(spark: SparkSession, rows: list[tuple[int, int, int, int]]) -> DataFrame:
    """A table of settings: trial, top_k, tau_s, tau_m, delta, thresholds in percent. It is as long as the search."""
    data = [(k, *row) for k, row in enumerate(rows)]
    return spark.createDataFrame(data, "trial int, top_k int, tau_s int, tau_m int, delta int")


def grid(spark: SparkSession, delta: int = 11, top_k: int = 1_000_000) -> DataFrame:
    return trials(spark, [(top_k, s, m, delta) for s, m in threshold_pairs()])


def trial_counts(scored: DataFrame, truth: DataFrame, entities: DataFrame, settings: DataFrame) -> DataFrame:
    """(trial, top_k, tau_s, tau_m, delta, source1_entity_id, n_true, n_pred, n_hit, n_any): what each setting would predict.

    scored has fused_rank if settings limit top_k. Pairs are labelled and shuffled by entity once; an entity's best
    score is the same for all settings of one top_k, and all settings are counted by one aggregate. settings is as
    long as the search, and becomes part of the plan.
    """
    key = "source1_entity_id"
    rows = settings.collect()
    labels = truth.select(key, F.col("matched_id").alias("candidate_entity_id")).distinct().withColumn("_true", F.lit(True))
    rank = F.col("fused_rank") if "fused_rank" in scored.columns else F.lit(1)
    within = Window.partitionBy(key)
    pairs = scored.join(labels, [key, "candidate_entity_id"], "left").select(key, "predicted_prob", F.col("_true").isNotNull().alias("hit"), rank.alias("rank"))
    pairs = pairs.withColumns({f"best{k}": F.max(F.when(F.col("rank") <= k, F.col("predicted_prob"))).over(within) for k in sorted({r["top_k"] for r in rows})})
    p = F.col("predicted_prob")
    counts = []
    for r in rows:
        best = F.col(f"best{r['top_k']}")
        ok = (F.col("rank") <= r["top_k"]) & (best >= r["tau_s"] / 100.0) & (p >= r["tau_m"] / 100.0) & (F.round(best - p, 9) <= r["delta"] / 100.0)
        counts += [F.count_if(ok).alias(f"p{r['trial']}"), F.count_if(ok & F.col("hit")).alias(f"h{r['trial']}")]
    # no setting takes a pair below all thresholds, as most are; settings look at the others only
    sums = pairs.filter(p >= min(r["tau_m"] for r in rows) / 100.0).groupBy(key).agg(*counts)
    any_ = pairs.groupBy(key).agg(*[F.count_if(F.col("rank") <= k).alias(f"any{k}") for k in sorted({r["top_k"] for r in rows})])
    n_true = truth.select(key, "matched_id").distinct().groupBy(key).agg(F.count("*").alias("n_true"))
    every = entities.select(key).distinct().join(n_true, key, "left").join(any_, key, "left").join(sums, key, "left")
    none = lambda c: F.coalesce(F.col(c), F.lit(0))
    each = [
        F.struct(*[F.lit(r[c]).alias(c) for c in ("trial", "top_k", "tau_s", "tau_m", "delta")], none(f"p{r['trial']}").alias("n_pred"), none(f"h{r['trial']}").alias("n_hit"), none(f"any{r['top_k']}").alias("n_any"))
        for r in rows
    ]
    return every.select(key, none("n_true").alias("n_true"), F.explode(F.array(*each)).alias("x")).select("x.trial", "x.top_k", "x.tau_s", "x.tau_m", "x.delta", key, "n_true", "x.n_pred", "x.n_hit", "x.n_any")


def trial_metrics(counts: DataFrame) -> DataFrame:
    """Of each setting: macro F0.5, and precision, recall and singleton accuracy. The means of precision and recall
    leave out entities without candidates and those with neither side."""
    p = F.when(F.col("n_pred") > 0, F.col("n_hit") / F.col("n_pred")).otherwise(0.0)
    r = F.when(F.col("n_true") > 0, F.col("n_hit") / F.col("n_true")).otherwise(0.0)
    counted = (F.col("n_any") > 0) & ((F.col("n_pred") > 0) | (F.col("n_true") > 0))
    single = F.col("n_true") == 0
    right = F.count_if(single & (F.col("n_pred") == 0)) / F.count_if(single)
    return counts.groupBy("trial", "top_k", "tau_s", "tau_m", "delta").agg(
        F.round(F.avg(f05(F.col("n_hit"), F.col("n_pred"), F.col("n_true"))), 4).alias("macro_f05"),
        F.round(F.coalesce(F.avg(F.when(counted, p)), F.lit(0.0)), 4).alias("macro_precision"),
        F.round(F.coalesce(F.avg(F.when(counted, r)), F.lit(0.0)), 4).alias("macro_recall"),
        F.round(F.when(F.count_if(single) > 0, right).otherwise(1.0), 4).alias("singleton_acc"),
    )


def best_setting(metrics: DataFrame) -> DataFrame:
    """The first setting, in grid order, of greatest F0.5."""
    return metrics.orderBy(F.desc("macro_f05"), "tau_s", "tau_m").limit(1)
