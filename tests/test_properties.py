"""Property and brute-force checks for operators without (or beyond) an SQL
oracle. Inputs are the driver's tables or deterministic derivations of them."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabula.operators import anomaly, neighbors, outliers, sample, window
from tabula.operators import models as MD
from tabula.plans.fixtures import lineitem_label, write_png_folders
from tabula.plans.scale import global_rank_total
from tabula.session import shared_path
from tabula.sources import images as IMG
from tabula.sources import json_io as J
from tabula.sources.tables import read_table

from .conftest import SF_MID, SF_SMALL


def _hot_events(spark, sf=SF_SMALL):
    """events where one user holds a third of all rows (skew fixture)."""
    e = read_table(spark, sf, "events", ["event_id", "ts", "user_id", "value"])
    return e.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0))
                        .otherwise(F.col("user_id"))) \
            .withColumn("value", F.when(F.col("event_id") % 4 == 0, F.lit(None).cast("double"))
                        .otherwise(F.col("value")))


def test_global_rank_is_contiguous_and_ordered(spark):
    e = read_table(spark, SF_SMALL, "events", ["event_id", "ts"])
    r, n = global_rank_total(e, ["ts", "event_id"], num_partitions=7)
    pdf = r.toPandas().sort_values(["ts", "event_id"])
    assert n == len(pdf)
    assert pdf["_grn"].tolist() == list(range(1, n + 1))


def test_lag_and_fills_under_a_hot_key(spark):
    e = _hot_events(spark)
    pdf = e.toPandas().sort_values(["user_id", "ts", "event_id"])
    g = pdf.groupby("user_id")["value"]
    exp_lag = g.shift(3)
    exp_ff = g.ffill()
    exp_bf = g.bfill()
    lag = window.lag_variable(e, "value", "ts", "user_id", 3, key="event_id").toPandas() \
        .set_index("event_id")["previous_value"]
    ff = window.forward_fill(e, "value", "ts", "user_id", key="event_id", out_col="f").toPandas() \
        .set_index("event_id")["f"]
    bf = window.backward_fill(e, "value", "ts", "user_id", key="event_id", out_col="b").toPandas() \
        .set_index("event_id")["b"]
    ids = pdf["event_id"].to_numpy()
    np.testing.assert_array_equal(lag.loc[ids].to_numpy(), exp_lag.to_numpy())
    np.testing.assert_array_equal(ff.loc[ids].to_numpy(), exp_ff.to_numpy())
    np.testing.assert_array_equal(bf.loc[ids].to_numpy(), exp_bf.to_numpy())


def test_rolling_mean_matches_pandas(spark):
    e = _hot_events(spark)
    pdf = e.toPandas().sort_values(["user_id", "ts", "event_id"])
    exp = pdf.groupby("user_id")["value"].transform(lambda s: s.rolling(5).mean())
    got = window.rolling_mean(e, "value", "ts", 5, "user_id", key="event_id").toPandas() \
        .set_index("event_id")["value_rolling_mean"]
    np.testing.assert_allclose(got.loc[pdf["event_id"]].to_numpy(dtype=float),
                               exp.to_numpy(dtype=float), rtol=1e-12, equal_nan=True)


@pytest.mark.parametrize("rows", [0, 1, 61])
@pytest.mark.parametrize("entity", [None, "who"])
def test_ordered_operators_over_tiny_slices_and_batches(spark, rows, entity):
    """Slices shorter than the lag, batches of three rows, NULL entities, text values."""
    data = [(i, None if i % 5 == 0 else "ab"[i % 2], i % 7, None if i % 3 else f"v{i}",
             None if i % 4 == 1 else float(i)) for i in range(rows)]
    df = spark.createDataFrame(data, "id long, who string, at int, name string, x double")
    pdf = pd.DataFrame(data, columns=["id", "who", "at", "name", "x"]).astype({"x": float, "name": object})
    pdf = pdf.assign(g="all" if entity is None else pdf["who"].fillna("-")).sort_values(["g", "at", "id"])
    names = pdf.groupby("g")["name"]
    conf = {"spark.sql.shuffle.partitions": "23", "spark.sql.execution.arrow.maxRecordsPerBatch": "3"}
    before = {c: spark.conf.get(c) for c in conf}
    for c, v in conf.items():
        spark.conf.set(c, v)
    try:
        args = dict(order_by="at", entity=entity, key="id")
        got = {"lag": window.lag_variable(df, ["name", "x"], offset=5, out_col=["o", "o2"], **args),
               "ff": window.forward_fill(df, "name", out_col="o", **args),
               "bf": window.backward_fill(df, "name", out_col="o", **args),
               "mean": window.rolling_mean(df, "x", window=4, min_periods=2, out_col="o", **args)}
        got = {c: {r["id"]: r["o"] for r in d.collect()} for c, d in got.items()}
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    mean = pdf.groupby("g")["x"].transform(lambda v: v.rolling(4, min_periods=2).mean()) if rows else pdf["x"]
    want = {"lag": names.shift(5), "ff": names.ffill(), "bf": names.bfill(), "mean": mean}
    for c, series in want.items():
        expected = {i: None if pd.isna(v) else v for i, v in zip(pdf["id"], series)}
        assert got[c].keys() == expected.keys(), c
        for i, v in expected.items():
            assert got[c][i] == (pytest.approx(v) if c == "mean" and v is not None else v), (c, i)


def test_knn_blocks_match_brute_force(spark):
    e = read_table(spark, SF_SMALL, "embeddings", ["vec_id", "embedding"])
    got = neighbors.knn_join(e, e, "vec_id", "vec_id", "embedding", k=4, exclude_self=True,
                             block_rows=60).toPandas()
    pdf = e.toPandas()
    x = np.stack(pdf["embedding"].to_numpy()).astype(np.float64)
    ids = pdf["vec_id"].to_numpy()
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)
    np.fill_diagonal(d, np.inf)
    exp = {}
    for i, q in enumerate(ids):
        order = np.lexsort((ids, d[i]))[:4]
        exp[q] = list(ids[order])
    got_map = got.sort_values(["vec_id", "neighbor_rank"]).groupby("vec_id")["neighbor_id"].apply(list)
    assert got_map.to_dict() == exp


def test_knn_visits_few_blocks_and_breaks_ties_by_id(spark):
    """Clustered points with many equal ones, cells cut into small blocks."""
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(c, 0.01, (60, 3)) for c in (0.0, 5.0, 50.0)] + [np.zeros((40, 3))])
    pdf = pd.DataFrame({"id": np.arange(len(x)) * 3, "v": list(x)})
    df = spark.createDataFrame(pdf)
    queries = df.filter("id % 2 = 0")
    got = neighbors.knn_join(queries, df, "id", "id", "v", k=6, block_rows=25).toPandas()
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)
    for i, group in got.sort_values("neighbor_rank").groupby("id"):
        assert list(group["neighbor_id"]) == list(pdf["id"][np.lexsort((pdf["id"], d[i // 3]))[:6]])
    assert got["id"].nunique() == queries.count()


def test_smote_with_categories_and_whole_numbers(spark):
    rng = np.random.default_rng(11)
    x = np.column_stack([rng.normal(size=80), rng.integers(0, 9, 80).astype(float)])
    colour = np.array(["red", "green", "blue", None], dtype=object)[rng.integers(0, 4, 80)]
    small = np.arange(80) < 20
    df = spark.createDataFrame(
        [(int(i), x[i].tolist(), colour[i], int(small[i])) for i in range(80)],
        "id long, v array<double>, colour string, label int")
    got = neighbors.oversample_smote(df, "label", "id", "v", k=3, categorical=["colour"], integer=[1]).toPandas()
    assert len(got) == 40 and set(got["label"]) == {1}
    side = np.median(x[:20].std(0))
    for row in got.itertuples():
        b = row.base_id
        d = ((x[:20] - x[b]) ** 2).sum(1) + side ** 2 * (colour[:20] != colour[b])
        d[b] = np.inf
        near = np.lexsort((np.arange(20), d.round(12)))[:3]
        assert row.neighbor_id in near
        votes = pd.Series([colour[i] or "" for i in near]).value_counts()
        assert (row.colour or "") == min(votes.index[votes == votes.max()])
        gap = (row.v[0] - x[b, 0]) / (x[row.neighbor_id, 0] - x[b, 0])
        assert 0 <= gap < 1
        assert row.v[1] == np.round(x[b, 1] + gap * (x[row.neighbor_id, 1] - x[b, 1]))


def test_outlier_report_by_five_methods(spark):
    """Far points are flagged by each joint method; shares follow the settings."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1000, 2))
    x[:5] += 12.0
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(1000), "a": x[:, 0], "b": x[:, 1]}))
    got = outliers.outlier_report(df, ["a", "b"], "id").toPandas()
    far = set(range(5))
    for m in ("elliptic", "isolation_forest", "one_class"):
        rows = got[got["method"] == m]
        assert set(rows["feature"]) == {"a,b"} and far <= set(rows["id"]) and rows["id"].is_unique, m
    assert (got["method"] == "elliptic").sum() == 100
    assert 400 <= (got["method"] == "one_class").sum() <= 600
    for f, v in (("a", x[:, 0]), ("b", x[:, 1])):
        z = set(np.nonzero(np.abs((v - v.mean()) / v.std()) > 3)[0])
        assert set(got[(got["method"] == "zscore") & (got["feature"] == f)]["id"]) == z
    # the moments themselves
    n, mean, cov = anomaly._moments(df.select(F.array("a", "b").alias("_x")), 2)
    assert n == 1000
    np.testing.assert_allclose(mean, x.mean(0))
    np.testing.assert_allclose(cov, np.cov(x.T, bias=True), rtol=1e-9)


def test_splits_are_disjoint_complete_and_sized(spark):
    o = read_table(spark, SF_SMALL, "orders", ["o_orderkey"])
    n = o.count()
    s = sample.split_holdout(o, "o_orderkey", 0.3).toPandas()
    assert len(s) == n and s["o_orderkey"].is_unique
    assert (s["split"] == "test").sum() == int(np.ceil(0.3 * n))
    f = sample.split_kfold(o, "o_orderkey", 7).toPandas()
    sizes = f.groupby("fold").size().sort_index().tolist()
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1 and len(sizes) == 7


def test_oversample_binary_balances(spark):
    lab = read_table(spark, SF_MID, "labels", ["doc_id", "toxic"])
    out = sample.oversample_binary(lab, "toxic", "doc_id").groupBy("toxic").count().toPandas()
    assert out["count"].nunique() == 1


def test_isolation_forest_flags_and_is_deterministic(spark):
    e = read_table(spark, SF_SMALL, "embeddings")
    wide = e.select("vec_id", *[F.col("embedding")[i].alias(f"e{i}") for i in range(16)])
    feats = [f"e{i}" for i in range(16)]
    a = anomaly.outliers_isolation_forest(wide, feats, "vec_id", 30, 128).toPandas()
    b = anomaly.outliers_isolation_forest(wide, feats, "vec_id", 30, 128).toPandas()
    pd.testing.assert_frame_equal(a.sort_values("vec_id").reset_index(drop=True),
                                  b.sort_values("vec_id").reset_index(drop=True))
    assert a["anomaly_score"].between(0, 1).all()
    c = anomaly.outliers_isolation_forest(wide, feats, "vec_id", 30, 128, contamination=0.1) \
        .toPandas()
    assert abs(c["is_outlier"].mean() - 0.1) < 0.03


def test_elliptic_flags_contamination_share(spark):
    e = read_table(spark, SF_SMALL, "embeddings")
    wide = e.select("vec_id", *[F.col("embedding")[i].alias(f"e{i}") for i in range(4)])
    out = anomaly.outliers_elliptic(wide, [f"e{i}" for i in range(4)], "vec_id", 0.1).toPandas()
    assert abs(out["is_outlier"].mean() - 0.1) < 0.02
    with pytest.raises(ValueError):
        small = wide.limit(10)
        anomaly.outliers_elliptic(small, [f"e{i}" for i in range(4)], "vec_id", 0.1)


def test_quantile_intervals_cover(spark):
    li = lineitem_label(spark, SF_MID).withColumn("k", F.xxhash64("l_orderkey", "l_linenumber",
                                                                   "l_partkey", "l_quantity"))
    tr, te = MD.holdout(li, "k")
    out = MD.intervals_quantile(tr, te, ["l_quantity", "l_discount", "l_tax"], "y", 0.95,
                                keep=["k", "y"]).toPandas()
    cover = ((out["y"] >= out["lower_PI"]) & (out["y"] <= out["upper_PI"])).mean()
    assert 0.92 < cover < 0.98


def test_linear_shap_is_additive(spark):
    import __spark_entry__ as E
    out = E.queries()["shap_values"](spark, SF_SMALL).toPandas()
    assert out["additive"].all()


def test_batch_and_stream_scores_agree(spark):
    import __spark_entry__ as E
    stream = E.queries()["score_stream"](spark, SF_SMALL).toPandas().sort_values("vec_id")
    assert len(stream) == read_table(spark, SF_SMALL, "embeddings").count()
    assert stream["probabilities"].map(lambda p: abs(sum(p) - 1) < 1e-9).all()


def test_images_read_and_checked(spark, tmp_path):
    e = read_table(spark, SF_SMALL, "embeddings")
    px = F.transform("embedding", lambda x: F.floor((x.cast("double") + 1.0) * 127.5))
    root = shared_path(spark, "img-test")
    write_png_folders(e.select("vec_id", "label", px.alias("px")), root, "label", "vec_id",
                          "px", 8)
    images, stats = IMG.read_image_folders(spark, root, image_size=8)
    assert images.count() == e.count()
    assert stats.first()["n_pixels"] == 64 * e.count()
    with pytest.raises(ValueError):
        IMG.read_image_folders(spark, root, image_size=28)
    with pytest.raises(ValueError):
        IMG.read_image_folders(spark, root, image_size=8, min_per_class=10_000)


def test_json_records_round_trip(spark):
    e = read_table(spark, SF_SMALL, "events", ["event_id", "event_type", "value"])
    path = shared_path(spark, "records")
    J.write_records_json(e, path)
    back = J.read_records_json(spark, path, "event_id BIGINT, event_type STRING, value DOUBLE")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, e.collect()))


def test_model_save_and_load(spark):
    from datetime import date
    emb = read_table(spark, SF_SMALL, "embeddings").select(
        "vec_id", "label", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(8)])
    model, acc = MD.train_and_export(emb, [f"e{i}" for i in range(8)], "label", "vec_id",
                                     shared_path(spark, "m"))
    p = MD.save_model(model, shared_path(spark, "models"), "lr", today=date(2024, 1, 2))
    assert p.endswith("lr_20240102")
    again = MD.load_model(p).transform(emb).select("prediction").collect()
    assert len(again) == emb.count() and 0 <= acc <= 1
