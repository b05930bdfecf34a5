"""Structured Streaming form of the landed-export ingest.

New export files arriving in a landing folder are picked up as a file
stream; each micro-batch is normalised (P2) and upserted into the raw table
(K2) in ``foreachBatch``.  The stream's progress lives in a checkpoint under
the cluster's shared ``spark.checkpoint.dir``, so a restarted job resumes
where it stopped, and a re-delivered batch is left out (its number is committed
with its rows).  ``Trigger.availableNow`` turns the stream into the daily
incremental run: process everything landed, then stop.
"""

from __future__ import annotations

from concurrent.futures import Future

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from occurra.operators.normalize import normalize_download
from occurra.plans.tables import FAN, GRACE_SECONDS, ensure_raw_table, upkeep, upsert_into_table
from occurra.schema import DOWNLOAD_FIELDS
from occurra.session import checkpoint_dir

ORDER = ["_file", "_block", "_row"]


# Header of the landed exports, in file order (the fixture export's layout).
DEFAULT_HEADER = (*DOWNLOAD_FIELDS, "classKey")


def download_text_schema(header: tuple[str, ...] = DEFAULT_HEADER) -> T.StructType:
    """The export header as text columns (a file stream needs its schema up
    front; CSV columns are matched by position, so give the header in order)."""
    return T.StructType([T.StructField(n, T.StringType()) for n in header])


def landed_export_stream(
    spark: SparkSession,
    landing: str,
    header: tuple[str, ...] = DEFAULT_HEADER,
    max_files_per_trigger: int = 64,
) -> DataFrame:
    """Tab-separated export files under ``landing`` as an unbounded DataFrame.

    ``enforceSchema=false`` makes Spark check each file's header against
    ``header``: a file with another column order fails instead of being read
    with shifted columns.  Quoted fields may hold line breaks, so a landed file
    is one split; a trigger has many files.
    """
    return (
        spark.readStream.schema(download_text_schema(header))
        .options(sep="\t", header="true", quote='"', escape='"', encoding="UTF-8",
                 enforceSchema="false", multiLine="true",
                 ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .csv(landing)
        .selectExpr("*", "_metadata.file_path as _file", "_metadata.file_block_start as _block")
    )


def start_landed_ingest(
    spark: SparkSession,
    landing: str,
    raw_table: str,
    name: str = "landed_exports",
    available_now: bool = True,
    header: tuple[str, ...] = DEFAULT_HEADER,
    fan: int = FAN,
    grace_seconds: float = GRACE_SECONDS,
) -> StreamingQuery:
    """Start the stream; each micro-batch is normalised and upserted, then the store is kept in shape.

    A micro-batch's number is committed with its rows under the stream's id, which
    its checkpoint keeps, so one that is delivered again, also after later ones,
    is left out.
    """
    ensure_raw_table(spark, raw_table)
    base = checkpoint_dir(spark)
    started: Future[str] = Future()

    def upsert_batch(batch: DataFrame, batch_id: int) -> None:
        # row position inside each file split (micro-batches apply in order)
        batch = batch.selectExpr("*", "monotonically_increasing_id() as _row")
        normalized = normalize_download(batch, carry=tuple(ORDER))
        session, stream = batch.sparkSession, (started.result(), batch_id)
        if upsert_into_table(session, raw_table, normalized, ORDER, stream) is not None:
            upkeep(session, raw_table, fan, grace_seconds=grace_seconds)

    writer = (
        landed_export_stream(spark, landing, header)
        .writeStream.queryName(name)
        .option("checkpointLocation", f"{base.rstrip('/')}/streams/{name}")
        .foreachBatch(upsert_batch)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    query = writer.start()
    started.set_result(query.id)
    return query
