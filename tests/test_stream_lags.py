"""Streaming lags by keyed state: equal to the batch form, across restarts."""

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabula.sources.tables import SCHEMAS
from tabula.streaming import bars as B
from tests.conftest import SF_SMALL

COLUMNS = ["bar_start", "close", "volume", "previous_hour_close", "previous_hour_high_low_range", "previous_hour_volume"]


@pytest.mark.parametrize("entity", [None, "event_type"])
def test_lags_go_on_after_a_restart(spark, tmp_path, entity):
    events = spark.read.schema(SCHEMAS["events"]).parquet(f"{SF_SMALL}/events.parquet")
    landing = str(tmp_path / "landing")
    cuts = ["2024-01-01", "2024-01-15", "2025-01-01"]
    out, state = str(tmp_path / "out"), str(tmp_path / "ck")
    for a, b in zip(cuts, cuts[1:]):
        # files land one after another; each run is a new query on the same checkpoint
        (events.filter((F.col("ts") >= F.lit(a).cast("timestamp_ntz")) & (F.col("ts") < F.lit(b).cast("timestamp_ntz")))
         .coalesce(1).write.mode("append").parquet(landing))
        B.bars_stream(spark, landing, SCHEMAS["events"], out, state, "ts", "value", "event_id", entity=entity, lag=3)
    key = [entity] if entity else []
    got = spark.read.parquet(out).select(*key, *COLUMNS).toPandas().sort_values([*key, "bar_start"])
    closed = events.agg(F.max("ts")).first()[0] - pd.Timedelta(minutes=10)
    batch = B.bars_with_lag(events, "ts", "value", "event_id", lag=3, entity=entity)
    want = (batch.filter(F.col("bar_end") <= F.lit(closed)).select(*key, *COLUMNS).toPandas()
            .sort_values([*key, "bar_start"]))
    assert len(got) > 500 and os.path.isdir(state)
    pd.testing.assert_frame_equal(got.reset_index(drop=True), want.reset_index(drop=True), check_dtype=False)
