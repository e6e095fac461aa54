"""``score_stream``: score an unbounded table with a saved pipeline model.

The model is loaded once on the driver and its transform is part of the
streaming plan; each micro-batch is scored by the executors and appended to
the sink. Batch scoring (``operators.models.score_batch``) and stream
scoring apply the same pipeline, so their outputs are identical.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import label_map


def score_stream(spark: SparkSession, model_path: str, source: str, schema: str, out_path: str,
                 checkpoint: str, keep=(), class_names: dict | None = None,
                 base_path: str | None = None, prepare=None) -> None:
    model = PipelineModel.load(model_path)
    reader = spark.readStream.schema(schema)
    if base_path:
        reader = reader.option("basePath", base_path)
    stream = reader.parquet(source)
    if prepare is not None:
        stream = prepare(stream)
    scored = model.transform(stream)
    pred = F.col("prediction").cast("int")
    out = scored.select(*keep, (label_map(pred, class_names) if class_names else pred).alias("prediction"),
                        vector_to_array("probability").alias("probabilities"))
    q = (out.writeStream.outputMode("append").format("parquet")
         .option("path", out_path).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
