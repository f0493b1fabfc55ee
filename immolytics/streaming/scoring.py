"""Score property requests as they arrive (M11 + M3 on a stream).

The reference scores one property per form submission; here requests land as
files (JSON lines or CSV) in a folder and a Structured Streaming query turns
each micro-batch into aligned feature rows, scores it with the trained
``PipelineModel`` and appends the predictions to a parquet sink. The stream is
stateless (no aggregation), so it needs no watermark; progress is kept in a
checkpoint under the shared folder, so a restarted query resumes exactly once.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.columns import price_per_m2
from ..operators.encode import OneHotModel
from ..operators.model import build_scoring_rows
from ..session import scratch_path


def scored_requests(requests: DataFrame, model: PipelineModel, encoder: OneHotModel,
                    train_columns: list[str], passthrough: list[str] = ()) -> DataFrame:
    """Batch or streaming: requests -> aligned features -> prediction and price per m2."""
    rows = build_scoring_rows(requests, encoder, list(passthrough) + list(train_columns))
    out = model.transform(rows).drop("features")
    return out.withColumn("prix_m2_predit", price_per_m2("prediction", "surface_habitable"))


def start_scoring_stream(spark: SparkSession, source_dir: str, schema: StructType | str,
                         model: PipelineModel, encoder: OneHotModel, train_columns: list[str],
                         sink_dir: str, passthrough: list[str] = (), fmt: str = "json",
                         checkpoint: str | None = None, available_now: bool = False) -> StreamingQuery:
    """Start the stream; ``available_now`` processes what is there and stops (batch-like runs, tests)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("sep", ";")
    requests = reader.load(source_dir)
    scored = scored_requests(requests, model, encoder, train_columns, passthrough)
    writer = (scored.writeStream.format("parquet").outputMode("append")
              .option("path", sink_dir)
              .option("checkpointLocation", checkpoint or scratch_path(spark, "scoring-stream-checkpoint")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
