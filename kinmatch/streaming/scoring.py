"""Arriving S1 files matched against a fixed set of targets: a stateless stream-static join in micro-batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..config import Blocking
from ..functions.normalize import normalize
from ..operators.retrieval import Index, build_index, retrieve
from ..sources.staging import staged
from ..sources.tables import RECORD


def stream_candidates(spark: SparkSession, folder: str, targets: DataFrame | Index, out: str, checkpoint: str, conf: Blocking | None = None, then: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Candidates of each new tab-separated S1 file in `folder`, written under out/batch=<number>.

    targets are clean records, indexed once, or an index of them. A batch that is run again after a failure overwrites its own folder, so each record's
    candidates stand once. then: what else to do with a batch's candidates, such as scoring and gating them.
    """
    conf = conf or Blocking()
    kept = targets if isinstance(targets, Index) else build_index(targets, conf)

    def match(batch: DataFrame, number: int) -> None:
        found = retrieve(staged(normalize(batch)), kept, conf)
        (then(found) if then else found).write.mode("overwrite").parquet(f"{out}/batch={number}")

    arriving = spark.readStream.schema(RECORD).options(sep="\t", header=True).csv(folder)
    return arriving.writeStream.foreachBatch(match).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
