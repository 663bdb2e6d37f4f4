"""The forest finds a planted signal; metrics agree with hand counts."""

import random

from pyspark.sql import Observation
from pyspark.sql import functions as F

from pulsevault.fixed_values import MODEL_FEATURES
from pulsevault.operators import ml as ML


def test_forest_finds_a_planted_signal(spark):
    rng = random.Random(7)
    rows = []
    for i in range(600):
        x = [rng.gauss(0, 1) for _ in MODEL_FEATURES]
        x[0] = x[0] * 12 + 75
        label = int(x[0] + rng.gauss(0, 3) > 85)
        rows.append((f"p{i % 40}", i, *x, label))
    schema = "patient_hk string, report_date int, " + ", ".join(f"{f} double" for f in MODEL_FEATURES) + ", label int"
    split = ML.stratified_split(spark.createDataFrame(rows, schema))
    asm, model = ML.train_forest(split, trees=30)
    report = {r.metric_group: r for r in ML.classification_metrics(ML.predict(asm, model, split)).collect()}
    assert report["roc_auc"].precision > 0.9
    assert ML.feature_importances(model).first().feature == MODEL_FEATURES[0]
    assert report["0"].support + report["1"].support == report["macro avg"].support == report["accuracy"].support


def test_a_session_that_has_observed_can_predict(spark):
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 3
    rows = [(f"p{i}", i, *[float(i % 7 + j) for j in range(len(MODEL_FEATURES))], i % 2, "train" if i < 40 else "test") for i in range(60)]
    schema = "patient_hk string, report_date int, " + ", ".join(f"{f} double" for f in MODEL_FEATURES) + ", label int, split string"
    split = spark.createDataFrame(rows, schema)
    asm, model = ML.train_forest(split, trees=3)
    assert not model.hasSummary and len(ML.predict(asm, model, split).collect()) == 20


def test_report_by_hand(spark):
    pred = spark.createDataFrame([(1, 1, .9), (1, 0, .2), (0, 0, .1), (0, 1, .8), (0, 0, .3)], "label int, prediction int, p_positive double")
    got = {r.metric_group: (round(r.precision, 6), r.recall and round(r.recall, 6), r.f1 and round(r.f1, 6), r.support)
           for r in ML.classification_metrics(pred).collect()}
    assert got["0"] == (0.666667, 0.666667, 0.666667, 3) and got["1"] == (0.5, 0.5, 0.5, 2)
    assert got["macro avg"] == (0.583333, 0.583333, 0.583333, 5) and got["weighted avg"] == (0.6, 0.6, 0.6, 5)
    assert got["accuracy"][0] == 0.6


def test_without_training_rows_every_test_row_is_reported(spark):
    ds = spark.createDataFrame([("p", 1, 0, "test")], "patient_hk string, report_date int, label int, split string")
    assert [tuple(r) for r in ML.predict(None, None, ds).collect()] == [("p", 1, 0, None, None)]


def test_exact_quantiles_by_refinement(spark):
    import random

    import numpy as np
    rng = random.Random(2)
    columns = {
        "plain": [rng.gauss(0, 1) for _ in range(501)],
        "repeated": [float(rng.choice([1, 1, 1, 2, 5])) for _ in range(501)],
        "one": [3.5] * 501,
        "wide": [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-9, 9) for _ in range(501)],
        "holes": [None if rng.random() < 0.4 else rng.randint(0, 9) / 10 for _ in range(501)],
    }
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns))
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 1.0]
    for bins in (16, ML.QUANTILE_BINS):
        got = {(r.column_name, r.prob): r.value for r in ML.exact_quantiles(df, list(columns), probs, bins=bins).collect()}
        for c, values in columns.items():
            known = [v for v in values if v is not None]
            for p in probs:
                np.testing.assert_allclose(got[c, p], np.quantile(known, p), rtol=1e-9)
    assert ML.exact_quantiles(df.limit(0), ["plain"], probs).count() == 0
