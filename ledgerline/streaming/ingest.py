"""Incremental ingest of landed feed windows with Structured Streaming.

Window folders (``dt=.../load_window=...``) of the denormalised order feed land
as JSON files; a file-source stream validates each micro-batch with the same
rule list as the batch layer, upserts it by order id into a keyed table and
logs its row-contract errors.  Each row carries its load order (date, window,
file time, file, place in the file), and the later load wins within a batch and
across batches: the table is the same for any number of files per trigger.  A
replayed micro-batch leaves the table unchanged and rewrites its own log
partition; progress is kept in a checkpoint folder on shared storage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline import schemas
from ledgerline.functions import rules as R
from ledgerline.operators import quality
from ledgerline.sources import sinks
from ledgerline.sources.files import LOAD_ORDER, _lower_names, _upper_schema, with_file_order, with_row_order, with_window_number


#: Columns of the metrics of an epoch.
METRICS = "rows_read bigint, rows_rejected bigint, keys_inserted bigint, keys_replaced bigint, keys_outdated bigint"


def feed2_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """Streaming read of feed-2 JSON files under ``landing_dir`` with the columns of their load order."""
    schema = _upper_schema(schemas.RAW_DATASET_2).add("dt", "string").add("load_window", "string")
    raw = (spark.readStream.schema(schema)
           .option("maxFilesPerTrigger", max_files_per_trigger)
           .json(landing_dir))
    return _lower_names(with_window_number(with_file_order(raw)))


def start_feed2_ingest(spark: SparkSession, landing_dir: str, table_path: str, checkpoint_location: str,
                       available_now: bool = True, exceptions_path: str | None = None,
                       max_files_per_trigger: int = 1000, metrics_path: str | None = None) -> StreamingQuery:
    """Validate each micro-batch (null replacement) and upsert it into ``table_path`` by order id.

    With ``exceptions_path`` the row-contract errors of each batch (one row
    per order and failing field) are written to ``exceptions_path/epoch=<id>``;
    a replayed epoch overwrites its own partition, so the log never holds a
    batch twice.  ``metrics_path`` gets one row per epoch in the same way: rows
    read, rows rejected (with an error), keys inserted, replaced and outdated.
    """
    raw = feed2_stream(spark, landing_dir, max_files_per_trigger)

    def upsert_batch(batch: DataFrame, epoch_id: int) -> None:
        batch = with_row_order(batch)
        batch.persist()  # read once from the landed files, used by both sinks
        try:
            spark_, rejected = batch.sparkSession, Observation("rejected")
            bad = F.size(quality.error_array(R.feed2_contract())) > 0
            seen = batch.observe(rejected, F.count_if(bad).alias("rows"))
            counts = sinks.load_table(spark_, table_path, quality.qualify(seen, R.feed2_rules()), ["order_id"], LOAD_ORDER)
            if metrics_path:
                row = (counts.rows_read, int(rejected.get["rows"]), counts.inserted, counts.replaced, counts.outdated)
                spark_.createDataFrame([row], METRICS).coalesce(1).write.mode("overwrite").parquet(f"{metrics_path}/epoch={epoch_id}")
            if exceptions_path:
                errors = quality.exceptions_all(batch, R.feed2_contract(), source="feed2")
                errors.write.mode("overwrite").parquet(f"{exceptions_path}/epoch={epoch_id}")
        finally:
            batch.unpersist()

    writer = (raw.writeStream.foreachBatch(upsert_batch)
              .option("checkpointLocation", checkpoint_location)
              .queryName(f"feed2_ingest_{abs(hash(table_path)) % 10**8}"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
