"""Bronze ingest as an available-now stream.

The landing folder of JSON deltas is read with ``readStream``; each
micro-batch is normalised and appended to the bronze change log
(``foreachBatch``), as ``auric.jobs.ingest`` does with its batch; readers rank the
log by key. The stream checkpoint records which files are done, so a restarted
run resumes where it stopped; a replayed micro-batch is harmless because
ranking the same rows twice gives the same table, and a late file with older
cursors never rolls a row back. A line that is not a record fails the stream.

This is the same work as ``auric.jobs.ingest`` for the incremental path,
run file-by-file instead of as one batch: ``Trigger.AvailableNow`` processes
everything landed so far (in ``max_files_per_trigger`` slices) and stops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

from auric.functions.normalize import normalize_record
from auric.sources.lake import LakeTable


def _as_text(schema: StructType) -> StructType:
    """Scalars are read as their JSON text (``primitivesAsString``); nested
    fields keep their declared type."""
    return StructType([f if isinstance(f.dataType, (StructType, ArrayType, MapType))
                       else StructField(f.name, StringType(), True) for f in schema.fields])


def stream_ingest(spark: SparkSession, landing_json: str, schema: StructType,
                  table: LakeTable, cursor: str, checkpoint: str,
                  max_files_per_trigger: int | None = None) -> int:
    """Append every JSON file under ``landing_json`` to ``table``; returns the
    number of micro-batches processed.

    No cursor filter is applied: the stream's file log already says which
    files are done, and a late file with older cursors must still be loaded."""
    reader = (spark.readStream.schema(_as_text(schema))
              .option("primitivesAsString", True).option("mode", "FAILFAST"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = normalize_record(reader.json(landing_json), cursor)
    batches = []

    def load(batch: DataFrame, epoch_id: int) -> None:
        table.append(batch, cursor)
        batches.append(epoch_id)

    q = (rows.writeStream.foreachBatch(load)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return len(batches)
