"""Incremental play ingest (T1) and micro-batch star upsert.

Landed JSON pages are read as a file stream; each micro-batch is flattened,
cleaned and loaded with ``load_star`` under the batch id
``stream-<query id>-<epoch>``.  The query id belongs to the stream's
checkpoint, so two streams into one warehouse, or one with a new checkpoint,
never share batch ids.  ``foreachBatch`` is at-least-once: the warehouse
remembers each stream's newest committed epoch, and a micro-batch that comes
again is a no-op, whether it has been compacted or not.  A reset checkpoint is
a new stream: it reads everything that is still landed, and adds it.

One bad record does not stop a stream: text that is no page, plays whose time or
duration can't be read and plays without a song or artist id are stored as the
micro-batch's rejects, with the reason and where they came from, in the same
commit as its good plays (``Warehouse.all_rejects``).  With ``fail_on_reject`` such
a record fails the micro-batch, and the stream stands until it is mended.

With ``identity`` a play counts once, also where landings overlap or a checkpoint was
reset: the warehouse keeps the identities of loaded plays by month, however late a
repetition comes, so there is no watermark after which it would count again.

Late data needs no rule here: fact cells are additive, so a late play
simply lands in (and adds to) its old cell.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cadence.operators.clean import RejectedPlaysError, examine_plays, good_plays, refused_rows
from cadence.operators.star import STREAM_PREFIX, load_star
from cadence.schemas import CORRUPT, LANDED_PAGE, SOURCE
from cadence.sources.raw_json import flatten_items, landed_items
from cadence.sources.warehouse import Warehouse


def staged_stream(spark: SparkSession, landing: str, multiline: bool = False,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Staged plays as text, and a row for each text that is no page (``_corrupt``)."""
    reader = (spark.readStream.schema(LANDED_PAGE).option("multiLine", multiline)
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
              .option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return flatten_items(landed_items(reader.json(landing)), (CORRUPT, SOURCE), strict=False)


def stream_name(spark: SparkSession, checkpoint: str) -> str:
    """The id of the streaming query that owns a checkpoint folder."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/metadata")
    stream = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(p)
    try:
        return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["id"]
    finally:
        stream.close()


def upsert_batch(warehouse: Warehouse, name: Callable[[], str], fail_on_reject: bool = False,
                 identity: bool = False):
    """The foreachBatch function: examine and load one micro-batch of the stream ``name()``."""
    def handle(batch: DataFrame, epoch_id: int) -> None:
        # An empty micro-batch is a no-op, not an error.  The probe runs on the
        # raw rows (stops at the first one); a batch whose rows are all cleaned
        # away still loads as an empty, harmless batch.
        if batch.isEmpty():
            return
        stream = name()
        path = warehouse.scratch_path("plays")
        try:
            # Stored, as the load reads the plays more than once: the files are parsed once.
            examine_plays(batch).write.parquet(path)
            examined = warehouse.spark.read.parquet(path)
            refused = refused_rows(examined)
            first = refused.select("reason", "source").first()
            if first is not None and fail_on_reject:
                raise RejectedPlaysError(f"{first.reason} in {first.source}")
            load_star(warehouse, good_plays(examined), f"{STREAM_PREFIX}{stream}-{epoch_id}",
                      fail_on_reject=fail_on_reject, stream=(stream, epoch_id),
                      refused=None if first is None else refused, identity=identity)
        finally:
            warehouse.delete(path)
    return handle


def start_incremental(spark: SparkSession, landing: str, warehouse: Warehouse, checkpoint: str,
                      available_now: bool = True, processing_time: str | None = None,
                      max_files_per_trigger: int | None = None,
                      multiline: bool = False, fail_on_reject: bool = False,
                      identity: bool = False) -> StreamingQuery:
    stream = staged_stream(spark, landing, multiline, max_files_per_trigger)
    handle = upsert_batch(warehouse, lambda: stream_name(spark, checkpoint), fail_on_reject, identity)
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


class StreamNotFinished(RuntimeError):
    """A time limit ran out before all landed files were read."""


def run_incremental(spark: SparkSession, landing: str, warehouse: Warehouse, checkpoint: str,
                    max_files_per_trigger: int | None = None, multiline: bool = False,
                    limit_s: float | None = None, fail_on_reject: bool = False,
                    identity: bool = False) -> None:
    """Process everything landed so far, then return.

    It takes as long as it takes.  A limit that the caller sets raises when it
    runs out; loaded micro-batches stay, and the next run goes on after them.
    """
    warehouse.create_tables()
    q = start_incremental(spark, landing, warehouse, checkpoint, available_now=True,
                          max_files_per_trigger=max_files_per_trigger, multiline=multiline,
                          fail_on_reject=fail_on_reject, identity=identity)
    try:
        finished = q.awaitTermination() if limit_s is None else q.awaitTermination(limit_s)
    finally:
        last = q.lastProgress
        if q.isActive:
            q.stop()
    if q.exception() is not None:
        raise q.exception()
    if finished is False:
        raise StreamNotFinished(f"files under {landing} are unread after {limit_s} s (last finished "
                                f"micro-batch: {last['batchId'] if last else 'none'}); run again to go on")
