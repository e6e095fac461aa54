"""Registered queries: bars with lag (batch and streaming), stream scoring."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from ..session import shared_path
from ..sources.tables import SCHEMAS, table_path
from ..streaming import bars as B
from ..streaming.score import score_stream
from .fixtures import t
from .registry import query

_BARS_SQL = """
WITH b AS (SELECT time_bucket(INTERVAL '5 minutes', ts) AS bar_start,
                  arg_min(value, ts) AS open, arg_max(value, ts) AS close,
                  max(value) - min(value) AS high_low_range, count(*) AS volume
           FROM events GROUP BY 1)
SELECT bar_start, bar_start + INTERVAL '5 minutes' AS bar_end, open, close, high_low_range, volume,
  lag(close, 12) OVER (ORDER BY bar_start) AS previous_hour_close,
  lag(high_low_range, 12) OVER (ORDER BY bar_start) AS previous_hour_high_low_range,
  lag(volume, 12) OVER (ORDER BY bar_start) AS previous_hour_volume
FROM b"""


@query("bars_with_lag", _BARS_SQL)
def q_bars_with_lag(spark, sf):
    e = t(spark, sf, "events", ["event_id", "ts", "value"])
    return B.bars_with_lag(e, "ts", "value", "event_id", "5 minutes", 12)


@query("bars_stream", """
SELECT time_bucket(INTERVAL '5 minutes', ts) AS bar_start, count(*) AS volume,
       max(value) - min(value) AS high_low_range FROM events GROUP BY 1
HAVING time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '5 minutes'
       <= (SELECT max(ts) FROM events) - INTERVAL '10 minutes'""")
def q_bars_stream(spark, sf):
    """The same bars from a Structured Streaming query (watermark 10 minutes
    over event time, append mode, availableNow trigger), read back from the
    Parquet sink. Append mode emits a bar only once the watermark (latest
    event time minus 10 minutes) has passed its end; the bars still open when
    the input ends stay in the state store, as the oracle states."""
    src, base = B.source_glob(table_path(sf, "events"))
    out, ck = shared_path(spark, "bars"), shared_path(spark, "bars-ck")
    B.bars_stream(spark, src, SCHEMAS["events"], out, ck, "ts", "value", "event_id",
                  watermark="10 minutes", base_path=base)
    bars = spark.read.parquet(out)
    return bars.select("bar_start", "volume", "high_low_range")


@query("bars_stream_lag", """
WITH b AS (SELECT time_bucket(INTERVAL '5 minutes', ts) AS bar_start, count(*) AS volume,
                  arg_max(value, ts) AS close, max(value) - min(value) AS high_low_range FROM events GROUP BY 1)
SELECT bar_start, close, high_low_range, volume,
  lag(close, 12) OVER (ORDER BY bar_start) AS previous_hour_close,
  lag(high_low_range, 12) OVER (ORDER BY bar_start) AS previous_hour_high_low_range,
  lag(volume, 12) OVER (ORDER BY bar_start) AS previous_hour_volume
FROM b WHERE bar_start + INTERVAL '5 minutes' <= (SELECT max(ts) FROM events) - INTERVAL '10 minutes'""")
def q_bars_stream_lag(spark, sf):
    """Closed bars of the stream with the bar twelve bars earlier, from keyed
    state; the same rows as ``bars_with_lag`` for every bar that is closed."""
    src, base = B.source_glob(table_path(sf, "events"))
    out, ck = shared_path(spark, "lagged"), shared_path(spark, "lagged-ck")
    B.bars_stream(spark, src, SCHEMAS["events"], out, ck, "ts", "value", "event_id",
                  watermark="10 minutes", base_path=base, lag=12)
    return spark.read.parquet(out).select("bar_start", "close", "high_low_range", "volume", "previous_hour_close",
                                          "previous_hour_high_low_range", "previous_hour_volume")


_EMB_FEATS = [f"e{i}" for i in range(64)]


def _emb_wide(df):
    return df.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(f"e{i}")
                                          for i in range(64)])


@query("score_stream")
def q_score_stream(spark, sf):
    """Train a pipeline on the embeddings, save it to the shared folder, then
    score the embeddings table as a stream with the loaded model."""
    emb = _emb_wide(t(spark, sf, "embeddings"))
    pipe = Pipeline(stages=[VectorAssembler(inputCols=_EMB_FEATS, outputCol="features"),
                            LogisticRegression(labelCol="label", maxIter=30)])
    path = shared_path(spark, "model")
    pipe.fit(emb).write().overwrite().save(path)
    src, base = B.source_glob(table_path(sf, "embeddings"))
    out, ck = shared_path(spark, "scored"), shared_path(spark, "scored-ck")
    score_stream(spark, path, src, SCHEMAS["embeddings"], out, ck, keep=["vec_id"],
                 base_path=base, prepare=_emb_wide)
    return spark.read.parquet(out)
