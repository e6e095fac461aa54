"""Event stream -> fixed-width bars (first, last, high-low range, count),
and the lag features computed over closed bars.

The same aggregation runs as a batch query over a table or as a Structured
Streaming query with a watermark: a bar is emitted once the watermark passes
its end, and rows later than the watermark are dropped by design.
"""

from __future__ import annotations

import os

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.window import lag_variable

LAGGED = ["close", "high_low_range", "volume"]
STORE = "spark.sql.streaming.stateStore.providerClass"


def bar_aggregates(df: DataFrame, ts: str, value: str, width: str = "5 minutes",
                   key: str | None = None, entity=None) -> DataFrame:
    """Group rows into ``width`` buckets (aligned to the epoch) per entity.
    first/last break ties on ``key``; partial aggregation per task."""
    order = F.struct(F.col(ts), F.col(key)) if key else F.col(ts)
    ent = [entity] if isinstance(entity, str) else list(entity or [])
    return (df.groupBy(*ent, F.window(ts, width).alias("bar"))
            .agg(F.min_by(value, order).alias("open"), F.max_by(value, order).alias("close"),
                 (F.max(value) - F.min(value)).alias("high_low_range"),
                 F.count(F.lit(1)).alias("volume"))
            .select(*ent, F.col("bar.start").alias("bar_start"), F.col("bar.end").alias("bar_end"),
                    "open", "close", "high_low_range", "volume"))


def with_bar_lags(bars: DataFrame, lag: int = 12, entity=None,
                  prefix: str = "previous_hour_") -> DataFrame:
    """Add ``previous_hour_{close,high_low_range,volume}``: the bar ``lag``
    bars earlier (12 five-minute bars = one hour), within ``entity``."""
    return lag_variable(bars, LAGGED, order_by="bar_start", entity=entity, offset=lag, key=None,
                        out_col=[f"{prefix}{c}" for c in LAGGED])


def _lag_processor(lag: int, prefix: str, name: str):
    """Keyed state of the streaming lags: the last ``lag`` closed bars of an
    entity, oldest first."""
    from pyspark.sql.streaming import StatefulProcessor

    class LastBars(StatefulProcessor):
        def init(self, handle):
            self.bars = handle.getListState("bars", "close double, high_low_range double, volume long")

        def handleInputRows(self, key, rows, timerValues):
            # the bars of one micro-batch come in any order; all of them start
            # after the bars of the batches before, as the watermark closed those
            new = pd.concat(list(rows)).sort_values("bar_start")
            new[name] = key[0]  # a constant key is no column of the rows
            past = [tuple(x) for x in self.bars.get()] if self.bars.exists() else []
            known = past + list(new[LAGGED].itertuples(index=False, name=None))
            lagged = [known[i - lag] if i >= lag else (None,) * 3 for i in range(len(past), len(known))]
            for j, c in enumerate(LAGGED):
                new[prefix + c] = pd.array([x[j] for x in lagged], "Int64" if c == "volume" else "Float64")
            self.bars.put([(float(a), float(b), int(c)) for a, b, c in known[-lag:]])
            yield new

        def close(self):
            pass

    return LastBars()


def lagged_bar_stream(bars: DataFrame, lag: int = 12, entity: str | None = None,
                      prefix: str = "previous_hour_") -> DataFrame:
    """``with_bar_lags`` over a stream of closed bars (append mode).

    An aggregation under a watermark emits a bar once, when the watermark has
    passed its end, so every micro-batch holds later bars than the ones before.
    ``transformWithState`` keeps ``lag`` bars per entity, whatever the length of
    the stream; without an entity all bars (one row per width of time) have one
    key. The state is part of the checkpoint: a restarted query goes on with it.
    """
    keyed = bars if entity else bars.withColumn("_all", F.lit(0))
    key = entity or "_all"
    keyed = keyed.select(key, *[c for c in keyed.columns if c != key])
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in keyed.schema]
                       + [f"{prefix}close double, {prefix}high_low_range double, {prefix}volume long"])
    out = keyed.groupBy(key).transformWithStateInPandas(
        statefulProcessor=_lag_processor(lag, prefix, key), outputStructType=schema, outputMode="Append", timeMode="None")
    return out if entity else out.drop("_all")


def bars_with_lag(df: DataFrame, ts: str, value: str, key: str, width: str = "5 minutes",
                  lag: int = 12, entity=None) -> DataFrame:
    """``bars_with_lag`` (batch form)."""
    return with_bar_lags(bar_aggregates(df, ts, value, width, key, entity), lag, entity)


def bars_stream(spark: SparkSession, source: str, schema: str, out_path: str, checkpoint: str,
                ts: str, value: str, key: str, width: str = "5 minutes",
                watermark: str = "10 minutes", base_path: str | None = None,
                entity: str | None = None, lag: int | None = None) -> None:
    """``bars_with_lag`` (streaming form): read a Parquet landing folder as a
    stream, aggregate closed bars under a watermark, append them (with ``lag``:
    and the bar ``lag`` bars earlier, from keyed state) to a Parquet sink. Runs
    until the available input is consumed (``availableNow``)."""
    reader = spark.readStream.schema(schema)
    if base_path:
        reader = reader.option("basePath", base_path)
    stream = reader.parquet(source)
    ntz = dict(stream.dtypes)[ts] == "timestamp_ntz"
    if ntz:  # event time must be TIMESTAMP; the session zone is UTC
        stream = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    bars = bar_aggregates(stream.withWatermark(ts, watermark), ts, value, width, key, entity)
    if lag:
        bars = lagged_bar_stream(bars, lag, entity)
    if ntz:
        bars = bars.withColumn("bar_start", F.col("bar_start").cast("timestamp_ntz")) \
                   .withColumn("bar_end", F.col("bar_end").cast("timestamp_ntz"))
    writer = (bars.writeStream.outputMode("append").format("parquet")
              .option("path", out_path).option("checkpointLocation", checkpoint).trigger(availableNow=True))
    before = spark.conf.get(STORE, None)
    if lag:  # list state is kept by the RocksDB provider only
        spark.conf.set(STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        q = writer.start()  # takes its own copy of the settings
    finally:
        spark.conf.set(STORE, before) if before else spark.conf.unset(STORE)
    q.awaitTermination()


def source_glob(table_path: str):
    """(glob, basePath) that lets a file stream read a single Parquet file."""
    return table_path[:-1] + f"[{table_path[-1]}]", os.path.dirname(table_path)
