"""Document fingerprints by one-permutation MinHash, in DataFrame expressions only.

Each shingle is hashed once; the hash's high bits name its bin and the bin keeps the least. An empty bin takes the
value of the full bin that a hash of (bin, full bin) ranks first: for each empty bin a random order of all bins,
of which the first full one counts, as in optimal densification. Of each value the low eight bits are kept, and
likeness is corrected for their chance agreement.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import table

BINS_LOG2 = 7
BINS = 1 << BINS_LOG2
BITS = 8
WIDTH = 5
#: Bytes of text ordered together to find each document's next.
BUCKET_BYTES = 16 << 20
MOST_BUCKETS = 1000
_SPACES = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value) with value computed once, however often it is used within lambdas."""
    return F.transform(F.array(value), then)[0]


def shingles(text: Column, width: int = WIDTH) -> Column:
    """Hashes of runs of `width` words, A-Z lower-cased; one of the whole sequence if it has fewer words."""
    words = F.split(F.trim(F.translate(text, _UPPER, _LOWER), F.lit(_SPACES)), r"[\x20\x09-\x0D]+")
    return let(
        words,
        lambda w: F.when(F.size(w) < width, F.array(F.xxhash64(F.array_join(w, " ")))).otherwise(
            let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: F.transform(F.sequence(F.lit(0), F.greatest(F.size(h) - width, F.lit(0))), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(width)])))
        ),
    )


def fingerprint(text: Column, width: int = WIDTH) -> Column:
    """BINS x BITS bits as hex."""
    bin_of = lambda x: F.shiftright(x, 64 - BINS_LOG2) + BINS // 2
    least = lambda s: F.filter(s, lambda x, i: (i == 0) | (F.shiftright(x, 64 - BINS_LOG2) != F.shiftright(F.get(s, i - 1), 64 - BINS_LOG2)))

    def dense(full: Column) -> Column:
        def fill(bins: Column) -> Column:
            def value(j: Column) -> Column:
                first = F.array_min(F.transform(bins, lambda b, i: F.xxhash64(j, b).bitwiseAND(F.lit(-BINS)).bitwiseOR(i.cast("long"))))
                return let(F.array_position(bins, j), lambda at: F.when(at > 0, F.get(full, (at - 1).cast("int"))).otherwise(F.get(full, first.bitwiseAND(F.lit(BINS - 1)).cast("int"))))

            return F.transform(F.sequence(F.lit(0).cast("long"), F.lit(BINS - 1).cast("long")), value)

        return let(F.transform(full, lambda x: bin_of(x).cast("long")), fill)

    low = F.transform(let(let(F.sort_array(shingles(text, width)), least), dense), lambda v: F.lpad(F.hex(v.bitwiseAND(F.lit((1 << BITS) - 1))), BITS // 4, "0"))
    return F.lower(F.array_join(low, ""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two fingerprints' shingle sets: agreement less what chance gives BITS bits."""
    size = BITS // 4
    same = F.aggregate(F.sequence(F.lit(0), F.lit(BINS - 1)), F.lit(0), lambda n, k: n + F.when(F.substring(a, k * size + 1, F.lit(size)) == F.substring(b, k * size + 1, F.lit(size)), 1).otherwise(0))
    chance = 2.0**-BITS
    return F.when(a == b, 1.0).otherwise(F.greatest(F.lit(0.0), (same / F.lit(float(BINS)) - chance) / (1 - chance)))


def with_next(docs: DataFrame, columns: list[str], size: Column, more: dict[str, Column] | None = None) -> DataFrame:
    """Adds `more` columns, and next_<column> for each of columns: that of the next row by (doc_id, text hash), null ids first,
    and the first row's after the last.

    Rows are dealt to ranges of ids by quantiles, once; of each range the first row also goes to the end of the
    range before it. There are at most MOST_BUCKETS ranges, so that is what the driver sees.
    """
    spark = docs.sparkSession
    keyed = docs.withColumn("_k", F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)).cast("long"))).withColumn("_h", F.xxhash64("text"))
    total = docs.agg(F.sum(size)).first()[0] or 0
    buckets = int(min(MOST_BUCKETS, max(1, -(-total // BUCKET_BYTES))))
    bounds = keyed.agg(F.percentile_approx("_k", [k / buckets for k in range(1, buckets)], 10_000)).first()[0] if buckets > 1 else []
    bounds = sorted(set(bounds or []))
    bucket = F.size(F.filter(F.array(*[F.lit(b).cast("long") for b in bounds]), lambda b: b < F.col("_k"))) if bounds else F.lit(0)
    keyed = keyed.withColumn("_bucket", bucket)
    firsts = sorted(keyed.groupBy("_bucket").agg(F.min(F.struct("_k", "_h")).alias("f")).collect())
    if not firsts:
        return docs.withColumns(more or {}).select("*", *[F.col(c).alias(f"next_{c}") for c in columns])
    to = spark.createDataFrame([(f["_k"], f["_h"], firsts[k - 1][0]) for k, (_, f) in enumerate(firsts)], "_k long, _h long, _to int")
    heads = keyed.join(F.broadcast(to), ["_k", "_h"]).dropDuplicates(["_to"]).withColumn("_bucket", F.col("_to")).drop("_to")
    names = [*docs.columns, "_k", "_h", "_bucket"]
    rows = keyed.select(*names, F.lit(0).alias("_head")).union(heads.select(*names, F.lit(1).alias("_head")))
    rows = rows.withColumns(more or {})  # once a row, after the ranges' first ones were found
    order = Window.partitionBy("_bucket").orderBy("_head", "_k", "_h")
    return rows.select(*docs.columns, *(more or {}), "_head", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns]).filter("_head = 0").drop("_head")


def document_fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next for each row.

    Null text is empty and, like any text without words, has the fingerprint of the empty sequence. Null doc_id come
    first; rows of one doc_id are ordered by their text's hash. A single document is its own next. Other columns are
    not read; an empty table gives an empty one.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    sized = with_next(plain, ["text", "fingerprint"], F.octet_length("text"), {"fingerprint": fingerprint(F.col("text"), width)})
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = sized.withColumn("n_chars", F.length("text").cast("long")).withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring(F.col("next_text"), F.lit(1), half)))
    done = edited.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", fingerprint(F.col("edited"), width).alias("edited_fingerprint"), "next_fingerprint")
    return done.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_fingerprints(table(spark, sf_dir, "documents"))
