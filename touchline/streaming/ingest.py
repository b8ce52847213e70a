"""New payload files into a history table, exactly once.

The daily load as an ``availableNow`` stream: the file source remembers which payloads it has seen, and each micro-batch
is one history batch.  A batch's id is the time of its load, so a stream with a new checkpoint goes on where a table
stands; the commit also names the stream and epoch it came from, and a micro-batch that is repeated after a lost driver
loads its own batch again.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.operators.changes import TableConfig
from touchline.sources import tables


def load_new_payloads(
    spark: SparkSession, folder: str, schema: str, flatten: Callable[[DataFrame], DataFrame], config: TableConfig, table_path: str,
    checkpoint: str, *, files_per_batch: int | None = None,
) -> None:
    """Load every payload file not loaded before, then stop.

    A table that closes what a batch lacks needs whole loads; a micro-batch isn't one, so it is refused.
    """
    if config.deletes == "close":
        raise ValueError("deletes='close' ends keys that a batch lacks; load whole batches with tables.load_batch")
    reader = spark.readStream.schema(schema).option("multiLine", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    payload = reader.json(folder).withColumn("ingest_timestamp", F.col("_metadata.file_modification_time").cast("string"))

    def load(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        # The checkpoint's own id: the same after a restart, another for a new checkpoint.
        stream = session.read.text(f"{checkpoint}/metadata").first()[0]
        origin = f"{json.loads(stream)['id']}:{epoch}"
        now = datetime.now(UTC).replace(tzinfo=None)
        batch_id = tables.batch_of(session, table_path, origin) or f"b{now:%Y%m%d%H%M%S%f}"
        tables.load_batch(session, table_path, config, flatten(batch), batch_id, now.isoformat(), origin=origin)

    stream = payload.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    stream.awaitTermination()
