"""Checks of output files: errors stop a submission, warnings don't."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import numbered

MATCHES = ["source1_entity_id", "matched_entity_ids"]
CANDIDATES = ["source1_entity_id", "candidate_entity_ids"]
EXAMPLES = 5
LEAST_COVERAGE = 0.99


@dataclass
class Report:
    errors: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)
    coverage: float = 1.0
    only_missing: bool = False

    @property
    def ok(self) -> bool:
        return not self.errors

    @property
    def may_package(self) -> bool:
        """Also if nothing but a few missing rows is wrong."""
        return self.ok or self.only_missing and self.coverage >= LEAST_COVERAGE


def violations(lists: DataFrame, required: DataFrame, valid: DataFrame | None = None) -> DataFrame:
    """(rule, source1_entity_id, id) of all broken rules. lists: source1_entity_id and ids, a string joined by commas;
    required and valid: entity_id. Ids aren't trimmed."""
    split = F.filter(F.split(F.coalesce("ids", F.lit("")), ","), lambda x: x != "")
    rows = lists.select("source1_entity_id", split.alias("a"))
    none = F.lit(None).cast("string").alias("id")
    rule = lambda name: F.lit(name).alias("rule")
    per_row = rows.groupBy("source1_entity_id").agg(F.count("*").alias("n"))
    single = rows.select("source1_entity_id", F.explode("a").alias("id"))
    parts = [
        per_row.filter("n > 1").select(rule("duplicate_row"), "source1_entity_id", none),
        rows.filter(F.size("a") != F.size(F.array_distinct("a"))).select(rule("duplicate_id"), "source1_entity_id", none),
        single.filter(F.col("id").startswith("S1-")).select(rule("self_match"), "source1_entity_id", "id"),
        single.filter(~F.col("id").rlike("^S[123]-")).select(rule("wrong_prefix"), "source1_entity_id", "id"),
        required.select(F.col("entity_id").alias("source1_entity_id")).join(rows, "source1_entity_id", "left_anti").select(rule("missing"), "source1_entity_id", none),
        per_row.join(required.select(F.col("entity_id").alias("source1_entity_id")), "source1_entity_id", "left_anti").select(rule("extra"), "source1_entity_id", none),
    ]
    if valid is not None:
        known = single.filter(F.col("id").rlike("^S[23]-"))
        parts.append(known.join(valid.select(F.col("entity_id").alias("id")), "id", "left_anti").select(rule("unknown_id"), "source1_entity_id", "id"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def not_candidates(matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """Matched ids that aren't among their row's candidates; both: source1_entity_id and ids."""
    ids = lambda df: df.select("source1_entity_id", F.explode(F.filter(F.split(F.coalesce("ids", F.lit("")), ","), lambda x: x != "")).alias("id"))
    return ids(matches).join(ids(candidates), ["source1_entity_id", "id"], "left_anti")


def _struct(at: Row) -> Column:
    return F.struct(F.lit(at["file"]).alias("file"), F.lit(at["block"]).cast("long").alias("block"), F.lit(at["row"]).cast("long").alias("row"))


def read_lists(spark: SparkSession, path: str, header: list[str], report: Report) -> DataFrame | None:
    """The rows of an id-list file, or None with an error if its form is wrong."""
    try:
        lines = numbered(spark.read.text(path))
        first = lines.orderBy("_at").first()
    except Exception as e:
        report.errors.append(f"{path} can't be read: {str(e).splitlines()[0]}")
        return None
    if first is None or not first[0].strip():
        report.errors.append(f"{path} is empty")
        return None
    if "\t" not in first[0] and "," in first[0]:
        report.errors.append(f"{path} is parted by commas; tabs are expected")
        return None
    if [x.strip().lower() for x in first[0].split("\t")] != header:
        report.errors.append(f"{path} has the header {first[0]!r}; expected {header}")
        return None
    foreign = lines.filter(~F.is_valid_utf8("value")).limit(EXAMPLES).collect()
    if foreign:
        report.errors.append(f"{path} isn't UTF-8 in lines such as {[r['value'][:80] for r in foreign]}")
    rest = lines.filter(~F.col("_at").eqNullSafe(_struct(first["_at"])))
    bad = rest.filter((F.trim("value") != "") & ~F.contains("value", F.lit("\t"))).limit(EXAMPLES).collect()
    if bad:
        report.errors.append(f"{path} has rows without a tab: {[r[0] for r in bad]}")
    parts = F.split("value", "\t", 2)
    return rest.filter(F.contains("value", F.lit("\t"))).select(F.trim(F.get(parts, F.lit(0))).alias("source1_entity_id"), F.trim(F.get(parts, F.lit(1))).alias("ids"))


def validate(spark: SparkSession, matches_path: str, required: DataFrame, candidates_path: str | None = None, valid: DataFrame | None = None) -> Report:
    """All rules over the files; each broken one is named with its count and first examples."""
    report = Report()
    kinds: set[str] = set()
    missing = 0

    def check(path: str, header: list[str]) -> DataFrame | None:
        nonlocal missing
        before = len(report.errors)
        lists = read_lists(spark, path, header, report)
        kinds.update(["form"] if len(report.errors) > before else [])
        if lists is None:
            return None
        found = violations(lists, required, valid).groupBy("rule").agg(F.count("*").alias("n"), F.slice(F.array_sort(F.collect_set(F.coalesce("id", "source1_entity_id"))), 1, EXAMPLES).alias("some"))
        for row in found.orderBy("rule").collect():
            report.errors.append(f"{path}: {row.rule} in {row.n} cases, such as {row.some}")
            kinds.add(row.rule)
            missing = max(missing, row.n) if row.rule == "missing" else missing
        return lists

    matches = check(matches_path, MATCHES)
    candidates = check(candidates_path, CANDIDATES) if candidates_path else None
    if candidates_path is None:
        report.warnings.append("no candidate file")
    if valid is None:
        report.warnings.append("ids aren't checked against the sources")
    if matches is not None and candidates is not None:
        outside = not_candidates(matches, candidates).count()
        if outside:
            report.warnings.append(f"{outside} matches aren't among their candidates")
    total = required.count()
    report.coverage = 1 - missing / total if total else 1.0
    report.only_missing = kinds == {"missing"}
    return report
