from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tablefit.operators.models import Model
from tablefit.operators.scoring import score


def score_stream(stream: DataFrame, models: dict[str, Model]) -> DataFrame:
    """``prediction_<alias>`` columns on a streaming DataFrame (stateless, no shuffle)."""
    return score(stream, models)


def start_scoring_stream(spark: SparkSession, source_dir: str, schema: T.StructType, models: dict[str, Model],
                         sink_dir: str, checkpoint: str | None = None, available_now: bool = True,
                         max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Parquet files arriving in ``source_dir`` -> scored parquet in ``sink_dir``.

    The checkpoint belongs to the sink: unless given, it is the folder beside it
    named ``<sink>_checkpoint``. A restarted query finds it there and takes up
    where it stopped, each file scored exactly once.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    scored = score_stream(reader.parquet(source_dir), models)
    writer = (scored.writeStream.format("parquet").option("path", sink_dir)
              .option("checkpointLocation", checkpoint or sink_dir.rstrip("/") + "_checkpoint")
              .outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
