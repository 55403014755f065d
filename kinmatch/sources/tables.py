"""Scans, sinks and caches."""

from __future__ import annotations

import hashlib
import json
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

RECORD = StructType([StructField(c, StringType()) for c in ("entity_id", "business_name", "business_address", "country")])
# Texts that stand for a missing field.
MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN",
    "None", "n/a", "nan", "null",
]


def read_records(spark: SparkSession, path: str, rows: int | None = None, missing: list[str] | None = None) -> DataFrame:
    """Tab-separated records with a header, all strings; texts of `missing` become null. rows: the first that many of the
    file, whichever tasks read it."""
    plain = spark.read.schema(RECORD).options(sep="\t", header=True, quote='"', mode="PERMISSIVE").csv(path)
    if rows is not None:
        plain = numbered(plain).orderBy("_at").limit(rows).drop("_at")
    values = MISSING if missing is None else missing
    return plain.select("entity_id", *[F.when(F.col(c).isin(values), None).otherwise(F.col(c)).alias(c) for c in RECORD.names[1:]])


def numbered(rows: DataFrame) -> DataFrame:
    """Adds _at, which grows along a file: by path and block where rows come from files, and by place in a task."""
    at = F.monotonically_increasing_id()
    try:
        return rows.withColumn("_at", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), at.alias("row")))
    except AnalysisException:  # not a scan
        return rows.withColumn("_at", F.struct(F.lit("").alias("file"), F.lit(0).cast("long").alias("block"), at.alias("row")))


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    """source1_entity_id and matched_ids, trimmed and without empties; a missing second column has none."""
    lines = spark.read.text(path).select(F.split("value", "\t").alias("f"))
    ids = F.split(F.coalesce(F.try_element_at("f", F.lit(2)), F.lit("")), ",")
    out = lines.select(F.trim(F.col("f")[0]).alias("source1_entity_id"), F.filter(F.transform(ids, lambda x: F.trim(x)), lambda x: x != "").alias("matched_ids"))
    return out.filter("source1_entity_id not in ('', 'source1_entity_id')")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """The distinct ids of a file's first column, whatever it is called, without header and blanks."""
    lines = numbered(spark.read.text(path))
    first = lines.groupBy("_at.file").agg(F.min("_at").alias("_at"))
    ids = lines.join(F.broadcast(first.select("_at")), "_at", "left_anti").select(F.trim(F.split("value", "\t")[0]).alias("entity_id"))
    return ids.filter(F.col("entity_id") != "").distinct()


_WHITE = " \t\n\r"


def _single_spaces(text: Column) -> Column:
    """Runs of white space as one space each. Plain replacing does short runs; only what has longer ones is left to a
    pattern, which looks at every letter."""
    for c in _WHITE[1:]:
        text = F.replace(text, F.lit(c), F.lit(" "))
    for _ in range(2):
        text = F.replace(text, F.lit("  "), F.lit(" "))
    return F.when(F.contains(text, F.lit("  ")), F.regexp_replace(text, " {2,}", " ")).otherwise(text)


def documents_as_records(documents: DataFrame) -> DataFrame:
    """Business records from documents: source, name, address and country follow from id, text and language. The first
    four words are the name and all others belong to the address."""
    words = F.split(F.btrim(F.coalesce("text", F.lit("")), F.lit(_WHITE)), f"[{_WHITE}]+", 5)
    rest = _single_spaces(F.coalesce(F.get("_w", F.lit(4)), F.lit("")))
    country = F.when(F.col("lang") == "en", "US").when(F.col("lang") == "de", "India").when(F.col("lang") == "fr", "France").when(F.col("lang") == "es", "Spain")
    legal = F.when(F.col("doc_id") % 4 == 0, " Inc").when(F.col("doc_id") % 4 == 1, " Pvt Ltd").when(F.col("doc_id") % 4 == 2, " SARL").otherwise("")
    return documents.withColumn("_w", words).select(
        F.concat(F.lit("S"), (F.col("doc_id") % 3 + 1).cast("string"), F.lit("-"), F.col("doc_id").cast("string")).alias("entity_id"),
        F.concat(F.concat_ws(" ", F.slice("_w", 1, 4)), legal).alias("business_name"),
        F.concat_ws(" ", F.col("n_chars").cast("string"), rest, (F.col("n_chars") + 10000).cast("string")).alias("business_address"),
        country.alias("country"),
    )


def split_sources(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S1 records, and the pool of S2 and S3."""
    source = F.split("entity_id", "-")[0]
    others = [records.filter(source == s) for s in ("S2", "S3")]
    return records.filter(source == "S1"), others[0].unionByName(others[1])


def documents_truth(documents: DataFrame) -> DataFrame:
    """Pairs of S1 and target ids whose texts are equal but for white space."""
    same = _single_spaces(F.btrim(F.coalesce("text", F.lit("")), F.lit(_WHITE)))
    rows = documents.select(F.concat(F.lit("S"), (F.col("doc_id") % 3 + 1).cast("string"), F.lit("-"), F.col("doc_id").cast("string")).alias("id"), F.sha2(same, 256).alias("h"))
    s1 = rows.filter(F.col("id").startswith("S1-")).select(F.col("id").alias("source1_entity_id"), "h")
    targets = rows.filter(~F.col("id").startswith("S1-")).select(F.col("id").alias("matched_id"), "h")
    return s1.join(targets, "h").select("source1_entity_id", "matched_id")


def joined_ids(ids: Column, order: Column) -> Column:
    """Aggregate: ids joined by commas in order; empty for none."""
    pairs = F.array_sort(F.collect_list(F.when(ids.isNotNull(), F.struct(order.alias("o"), ids.alias("i")))))
    return F.array_join(F.transform(pairs, lambda x: x["i"]), ",")


def write_id_lists(rows: DataFrame, path: str, order: str | None = None) -> None:
    """One tab-separated line a row with a header, nothing quoted, empty lists as nothing. order: a column to sort by,
    left out of the file."""
    if order:
        rows = rows.repartitionByRange(F.col(order)).sortWithinPartitions(order).drop(order)
    rows.write.mode("overwrite").options(sep="\t", header=True, quote="", emptyValue="").csv(path)


def write_single(rows: DataFrame, path: str, order: str | None = None, sep: str = "\t") -> None:
    """One file with one header. Rows are written in parallel in order, and the parts' bytes are then put together."""
    spark = rows.sparkSession
    names = [c for c in rows.columns if c != order]
    if order:
        rows = rows.repartitionByRange(F.col(order)).sortWithinPartitions(order).drop(order)
    parts = f"{path}-parts"
    rows.select(*names).write.mode("overwrite").options(sep=sep, header=False, quote="", emptyValue="", nullValue="").csv(parts)
    _put_together(spark, parts, path, sep.join(names) + "\n")


def _put_together(spark: SparkSession, parts: str, path: str, header: str) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(parts)
    system = at.getFileSystem(conf)
    out = system.create(jvm.org.apache.hadoop.fs.Path(path), True)
    try:
        out.write(bytearray(header.encode()))
        for name in sorted(s.getPath().getName() for s in system.listStatus(at) if s.getPath().getName().startswith("part-")):
            part = system.open(jvm.org.apache.hadoop.fs.Path(at, name))
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, conf, False)
            part.close()
    finally:
        out.close()
    system.delete(at, True)


def filter_lines(spark: SparkSession, path: str, ids: DataFrame, out: str) -> None:
    """A file's header and those of its lines, as they are, whose entity_id is in ids (entity_id)."""
    lines = numbered(spark.read.text(path))
    header = lines.orderBy("_at").first()["value"]
    column = header.rstrip("\r").split("\t").index("entity_id")
    kept = lines.withColumn("entity_id", F.trim(F.get(F.split(F.rtrim("value", F.lit("\r")), "\t"), F.lit(column)))).join(ids.select("entity_id").distinct(), "entity_id", "left_semi")
    kept.repartitionByRange(F.col("_at")).sortWithinPartitions("_at").select("value").write.mode("overwrite").text(f"{out}-parts")
    _put_together(spark, f"{out}-parts", out, header + "\n")


def in_file_order(rows: DataFrame, key: str = "entity_id") -> DataFrame:
    """The first row of each key."""
    first = Window.partitionBy(key).orderBy("_at")
    return rows.withColumn("_at", F.monotonically_increasing_id()).withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n", "_at")


def cached(spark: SparkSession, folder: str, key: dict, make: Callable[[], DataFrame]) -> DataFrame:
    """make()'s table from the cache folder, kept by a hash of all that it depends on; written if absent."""
    name = hashlib.sha256(json.dumps(key, sort_keys=True, default=str).encode()).hexdigest()[:24]
    path = f"{folder.rstrip('/')}/{name}"
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(fs_path):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def package(paths: dict[str, str], archive: str, skip: tuple[str, ...] = (".pyc", ".parquet"), skip_dirs: tuple[str, ...] = ("__pycache__", ".git")) -> list[str]:
    """A zip of files and folders on the driver (name in the archive: path); the names in it."""
    names = []
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for name, source in sorted(paths.items()):
            root = Path(source)
            for file in [root] if root.is_file() else sorted(p for p in root.rglob("*") if p.is_file()):
                within = name if root.is_file() else f"{name}/{file.relative_to(root).as_posix()}"
                if file.suffix not in skip and not set(file.relative_to(root).parts[:-1] if file != root else ()) & set(skip_dirs):
                    out.write(file, within)
                    names.append(within)
    return names
