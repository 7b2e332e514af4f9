"""Load each new file of a sales-target drop folder as it arrives.

The batch job (``finwater.plans.rep_load``) replaces the target with one
file; this is the same load for a folder that keeps receiving files:
``readStream.csv`` picks up new files only (the file source's checkpointed
log), each micro-batch is validated with the same checks, good lines go to
the target and bad lines to the quarantine.  Each batch writes into its own
``epoch=<id>`` folder with overwrite, so a batch replayed after a failure
replaces its own output instead of appending twice.  IDs continue after
the largest ID of earlier epochs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from finwater.operators.loads import dense_ids, validate_fields
from finwater.plans.rep_load import (
    ID_ORDER,
    accepted,
    checked_lines,
    sink_error_path,
    sink_errors,
    source_errors,
    store_checked,
    target_columns,
)
from finwater.schema import TARGET_COLUMNS
from finwater.session import delete_path, path_exists, shared_scratch
from finwater.sources.csv_drop import DEFAULT_FORMAT, TEXT_SCHEMA, DropFormat, decoded, drop_lines, needs_records, parse_lines


def drop_stream(spark: SparkSession, drop_dir: str, fmt: DropFormat = DEFAULT_FORMAT, max_files: int | None = None) -> DataFrame:
    """New files of the folder: fields as text, or raw lines where rows are told
    per micro-batch (``parse_lines``; a file lies whole in one of them)."""
    reader = spark.readStream.option("maxFilesPerTrigger", max_files) if max_files else spark.readStream
    if needs_records(fmt):
        return drop_lines(reader, drop_dir, fmt)
    reader = reader.schema(TEXT_SCHEMA).options(**fmt.options()).option("enforceSchema", False)
    return decoded(reader.csv(drop_dir), fmt)


def _ids_path(target_path: str) -> str:
    # a hidden folder: parquet readers of the target skip names starting with '_'
    return f"{target_path.rstrip('/')}/_ids"


def _max_id_before(spark: SparkSession, target_path: str, epoch_id: int) -> int:
    """Largest ID of earlier epochs, from one-row markers (not from the
    target itself, whose size grows with every batch)."""
    ids = _ids_path(target_path)
    if not path_exists(spark, ids):
        return 0
    value = spark.read.parquet(ids).filter(F.col("epoch") < epoch_id).agg(F.max("max_id").alias("m")).first()["m"]
    return int(value or 0)


def load_batch(
    batch: DataFrame, epoch_id: int, target_path: str, quarantine_path: str, fmt: DropFormat = DEFAULT_FORMAT
) -> None:
    """One parse of the micro-batch: every line is stored with its checks, and
    target, quarantine and the sink's errors are taken from that copy."""
    spark = batch.sparkSession
    validated = validate_fields(parse_lines(batch, fmt) if needs_records(fmt) else batch)
    path = shared_scratch(spark, "staging/checked", unique=True)
    stored, _ = store_checked(checked_lines(validated, target_columns()), path)
    base = _max_id_before(spark, target_path, epoch_id)
    rows = dense_ids(accepted(stored), ID_ORDER).withColumn("ID", F.col("ID") + F.lit(base))
    out = f"{target_path.rstrip('/')}/epoch={epoch_id}"
    rows.select(*TARGET_COLUMNS).write.mode("overwrite").parquet(out)
    for errors, to in ((source_errors, quarantine_path), (sink_errors, sink_error_path(quarantine_path))):
        errors(stored).write.mode("overwrite").parquet(f"{to.rstrip('/')}/epoch={epoch_id}")
    # the marker is written last: a replayed batch rewrites data and marker
    top = spark.read.parquet(out).agg(F.max("ID").alias("max_id")).withColumn("max_id", F.coalesce("max_id", F.lit(base)))
    top.coalesce(1).write.mode("overwrite").parquet(f"{_ids_path(target_path)}/epoch={epoch_id}")
    delete_path(spark, path)


def start_drop_loader(
    spark: SparkSession,
    drop_dir: str,
    target_path: str,
    quarantine_path: str,
    checkpoint_location: str,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
    fmt: DropFormat = DEFAULT_FORMAT,
) -> StreamingQuery:
    """Start the loader; ``available_now`` processes what is there and stops
    (in several micro-batches when ``max_files_per_trigger`` is set)."""
    writer = (
        drop_stream(spark, drop_dir, fmt, max_files=max_files_per_trigger)
        .writeStream.foreachBatch(lambda df, epoch: load_batch(df, epoch, target_path, quarantine_path, fmt))
        .option("checkpointLocation", checkpoint_location)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
