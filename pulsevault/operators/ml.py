"""ML consumption of the feature mart (ML1-ML10): profile, label statistics, box-plot data,
pairwise correlations, complete-case dataset, deterministic stratified split, MLlib random
forest and its metrics. Everything stays distributed; only metrics and importances (a handful
of numbers) reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsevault.fixed_values import (
    EDA_BOX_FEATURES, EDA_CORR_FEATURES, FOREST_TREES, MODEL_FEATURES, MODEL_SEED, TOPK_TRAINING_ROWS,
    TRAIN_FRACTION,
)
from pulsevault.session import scratch_path

LABEL = "anomaly_next_24h"
PCT_ACCURACY = 10000


def topk_recent(mart: DataFrame, k: int = TOPK_TRAINING_ROWS) -> DataFrame:
    """SRT1: newest k rows by report_date (patient key breaks ties) — a top-k, not a full sort."""
    return mart.orderBy(F.col("report_date").desc(), F.col("patient_hk")).limit(k)


def profile(mart: DataFrame) -> DataFrame:
    """ML1: shape, label rate, date range, distinct patients — one aggregate."""
    return mart.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(mart.columns)).cast("long").alias("n_cols"),
        F.count_if(F.col(LABEL)).alias("n_positive"),
        F.round(F.count_if(F.col(LABEL)) / F.count(F.lit(1)), 6).alias("anomaly_rate"),
        F.min("report_date").alias("min_date"),
        F.max("report_date").alias("max_date"),
        F.count_distinct("patient_hk").alias("n_patients"),
    )


def column_info(mart: DataFrame) -> DataFrame:
    """ML1 info(): type and number of known values of every column, in one aggregate."""
    row = mart.agg(*[F.count(c).alias(f"c{i}") for i, c in enumerate(mart.columns)])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("dtype"), F.col(f"c{i}").alias("n_known"))
        for i, (c, t) in enumerate(mart.dtypes)])).alias("r")).select("r.*")


#: Bins that an interval is cut into in each round of ``exact_quantiles``.
QUANTILE_BINS = 2048


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float], bins: int = QUANTILE_BINS) -> DataFrame:
    """(column_name, prob, value): exact quantiles with linear interpolation, by refinement of histograms.

    Every wanted rank starts with its column's range. A round counts the values of each range in ``bins`` bins (a
    partial aggregate; at most ``bins`` rows per column and rank reach the driver) and goes on with the smallest
    and largest value of the bin that holds the rank, until these are equal. Nulls and NaN are left out."""
    spark = df.sparkSession
    path = scratch_path(spark, "quantiles")
    df.select(*[F.col(c).cast("double").alias(c) for c in columns]).write.parquet(path)
    values = spark.read.parquet(path).select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("v")) for c in columns])).alias("r")).select("r.*") \
        .where(F.col("v").isNotNull() & ~F.isnan("v"))
    spans = {r["column_name"]: r for r in values.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect()}
    # (column, rank from 0) -> (smallest value that it can be, largest, how many values are smaller than the smallest)
    at = {(c, rank): (r["low"], r["high"], 0) for c, r in spans.items() for p in probs
          for rank in (int(p * (r["n"] - 1)), min(int(p * (r["n"] - 1)) + 1, r["n"] - 1))}
    while wide := sorted({(c, low, high) for (c, _), (low, high, _) in at.items() if low < high}):
        bounds = spark.createDataFrame(wide, "column_name string, low double, high double")
        v, low, high = F.col("v"), F.col("low"), F.col("high")
        rows = values.join(F.broadcast(bounds), "column_name").where(v.between(low, high))  # a few rows per column
        bin_ = F.least(F.floor((v / 2 - low / 2) / (high / 2 - low / 2) * bins), F.lit(bins - 1))
        found: dict = {}
        for r in rows.groupBy("column_name", "low", "high", bin_.alias("bin")).agg(
                F.count(F.lit(1)).alias("n"), F.min("v").alias("a"), F.max("v").alias("z")).orderBy("bin").collect():
            found.setdefault((r["column_name"], r["low"], r["high"]), []).append(r)
        for (c, rank), (low_, high_, below) in at.items():
            for r in found.get((c, low_, high_), []) if low_ < high_ else []:
                if rank < below + r["n"]:
                    at[c, rank] = (r["a"], r["z"], below)
                    break
                below += r["n"]
    out = []
    for c, r in spans.items():
        for p in probs:
            place = p * (r["n"] - 1)
            a, z = at[c, int(place)][0], at[c, min(int(place) + 1, r["n"] - 1)][0]
            out.append((c, p, a + (z - a) * (place - int(place))))
    return spark.createDataFrame(out, "column_name string, prob double, value double")


def describe(mart: DataFrame, columns: list[str]) -> DataFrame:
    """ML1 describe(): count/mean/std/min/quartiles/max per numeric column, long format. The quartiles are exact
    (linear interpolation), found by refinement; the rest is one pass."""
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__n"), F.avg(x).alias(f"{c}__mean"), F.stddev_samp(x).alias(f"{c}__std"),
                 F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    row = mart.agg(*aggs)
    rows = row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"{c}__{x}").alias(x) for x in ("n", "mean", "std", "min", "max")])
        for c in columns])).alias("r")).select("r.*")
    q = exact_quantiles(mart, columns, [0.25, 0.5, 0.75]).groupBy("column_name").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(f"q{round(100 * p)}") for p in (0.25, 0.5, 0.75)])
    return rows.join(F.broadcast(q), "column_name", "left").select("column_name", "n", "mean", "std", "min", "q25", "q50", "q75", "max")


def label_counts(mart: DataFrame) -> DataFrame:
    """ML2."""
    return mart.groupBy(LABEL).agg(F.count(F.lit(1)).alias("n"))


def rate_by_tier(mart: DataFrame) -> DataFrame:
    """ML3/SRT5: label rate per risk tier, highest first."""
    g = mart.groupBy("risk_tier").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(LABEL)).alias("positives"))
    return g.withColumn("rate", F.round(F.col("positives") / F.col("n"), 6)).orderBy(F.col("rate").desc(), "risk_tier")


def boxplot_stats(mart: DataFrame, features: list[str] = EDA_BOX_FEATURES) -> DataFrame:
    """ML4: per feature and label — quartiles (percentile sketch), 1.5·IQR whiskers, outlier count.

    Long format via a bounded unpivot (one row per feature per mart row); quartiles aggregate
    map-side; the whisker pass joins the tiny (features x 2 labels) stats table back, which is
    broadcast-safe by construction.
    """
    longf = mart.select(LABEL, F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("decimal(12,4)").alias("value")) for f in features
    ])).alias("r")).select(F.col(LABEL).alias("label"), "r.feature", "r.value").where(F.col("value").isNotNull())
    q = longf.groupBy("feature", "label").agg(
        F.count(F.lit(1)).alias("n"),
        F.percentile_approx("value", [0.25, 0.5, 0.75], PCT_ACCURACY).alias("__q"))
    q = q.select("feature", "label", "n", F.col("__q")[0].alias("q1"), F.col("__q")[1].alias("median"),
                 F.col("__q")[2].alias("q3"))
    q = q.withColumn("lo_fence", F.col("q1") - (F.col("q3") - F.col("q1")) * F.lit(1.5).cast("decimal(2,1)")) \
         .withColumn("hi_fence", F.col("q3") + (F.col("q3") - F.col("q1")) * F.lit(1.5).cast("decimal(2,1)"))
    j = longf.join(F.broadcast(q.select("feature", "label", "lo_fence", "hi_fence")), ["feature", "label"])
    inside = F.col("value").between(F.col("lo_fence"), F.col("hi_fence"))
    w = j.groupBy("feature", "label").agg(
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"))
    return q.join(w, ["feature", "label"]).select(
        "feature", "label", "n", "q1", "median", "q3",
        F.col("whisker_low").cast("decimal(12,4)").alias("whisker_low"),
        F.col("whisker_high").cast("decimal(12,4)").alias("whisker_high"), "n_outliers")


def correlations(mart: DataFrame, features: list[str] = EDA_CORR_FEATURES, digits: int = 6) -> DataFrame:
    """ML5: Pearson correlation for every feature pair (label included), pairwise NULL skip —
    all pairs in one aggregate pass, then unpivoted."""
    cols = features + [LABEL]
    x = mart.select(*[F.col(c).cast("double").alias(c) for c in cols])
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    row = x.agg(*[F.corr(a, b).alias(f"p{i}") for i, (a, b) in enumerate(pairs)])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("feature_x"), F.lit(b).alias("feature_y"), F.round(F.col(f"p{i}"), digits).alias("corr"))
        for i, (a, b) in enumerate(pairs)])).alias("r")).select("r.*")


def model_dataset(mart: DataFrame, features: list[str] = MODEL_FEATURES) -> DataFrame:
    """ML6: complete cases over the features and the label; booleans as 0/1, label as int."""
    cols = features + [LABEL]
    d = mart.select("patient_hk", "report_date", *cols).na.drop(subset=cols)
    return d.select("patient_hk", "report_date",
                    *[F.col(c).cast("double").alias(c) for c in features],
                    F.col(LABEL).cast("int").alias("label"))


def split_bucket(*key_cols) -> F.Column:
    """Deterministic 0-99 bucket from an MD5 of the key (partition- and rerun-independent)."""
    h = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in key_cols]))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("long") % 100


def stratified_split(ds: DataFrame, train_fraction: float = TRAIN_FRACTION) -> DataFrame:
    """ML7: 80/20 split, drawn independently inside each label class by key hash (stratified)."""
    b = split_bucket("patient_hk", "report_date", "label")
    return ds.withColumn("split", F.when(b < int(train_fraction * 100), "train").otherwise("test"))


def class_weights(train: DataFrame) -> DataFrame:
    """'balanced' weights n / (k * n_label) as a tiny per-label table (k labels)."""
    c = train.groupBy("label").agg(F.count(F.lit(1)).alias("n_label"))
    tot = train.agg(F.count(F.lit(1))).scalar()
    k = c.agg(F.count(F.lit(1))).scalar()
    return c.select("label", (tot / (k * F.col("n_label"))).alias("weight"))


def train_forest(split_df: DataFrame, features: list[str] = MODEL_FEATURES, trees: int = FOREST_TREES,
                 seed: int = MODEL_SEED):
    """ML8: MLlib RandomForestClassifier(100 trees, balanced class weights, seed 42)."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    asm = VectorAssembler(inputCols=features, outputCol="features")
    train = split_df.where(F.col("split") == "train")
    if train.isEmpty():  # no complete cases (tiny inputs): no model, null predictions downstream
        return asm, None
    train = train.join(F.broadcast(class_weights(train)), "label")
    rf = RandomForestClassifier(numTrees=trees, seed=seed, weightCol="weight", labelCol="label",
                                featuresCol="features")
    # a copy is without the training summary: that holds the session, which once it has observed a write (the daily batch)
    # cannot be sent to tasks with the model
    model = rf.fit(asm.transform(train)).copy()
    return asm, model


def predict(asm, model, split_df: DataFrame) -> DataFrame:
    test = split_df.where(F.col("split") == "test")
    if model is None:  # no training rows: every test row is reported, without a prediction
        return test.select("patient_hk", "report_date", "label", F.lit(None).cast("int").alias("prediction"),
                           F.lit(None).cast("double").alias("p_positive"))
    from pyspark.ml.functions import vector_to_array
    out = model.transform(asm.transform(test))
    return out.select("patient_hk", "report_date", "label", F.col("prediction").cast("int").alias("prediction"),
                      # a single-class training set yields a 1-element probability vector
                      F.coalesce(F.get(vector_to_array("probability"), 1), F.lit(0.0)).alias("p_positive"))


def classification_metrics(pred: DataFrame) -> DataFrame:
    """ML9: per-class precision/recall/F1/support, their macro and support-weighted averages, accuracy and
    ROC-AUC, computed by aggregates."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    per = []
    for cls in (0, 1):
        tp = F.count_if((F.col("prediction") == cls) & (F.col("label") == cls))
        pp = F.count_if(F.col("prediction") == cls)
        ap = F.count_if(F.col("label") == cls)
        per.append(pred.agg(tp.alias("tp"), pp.alias("pp"), ap.alias("ap")).select(
            F.lit(str(cls)).alias("metric_group"),
            F.when(F.col("pp") > 0, F.col("tp") / F.col("pp")).otherwise(0.0).alias("precision"),
            F.when(F.col("ap") > 0, F.col("tp") / F.col("ap")).otherwise(0.0).alias("recall"),
            F.col("ap").alias("support"), "tp", "pp", "ap"))
    out = per[0].unionByName(per[1]).select(
        "metric_group", "precision", "recall",
        F.when((F.col("precision") + F.col("recall")) > 0,
               2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
        .alias("f1"), "support")
    means = ["precision", "recall", "f1"]
    weighted = [F.when(F.sum("support") > 0, F.sum(F.col(c) * F.col("support")) / F.sum("support")).otherwise(0.0).alias(c) for c in means]
    averages = out.agg(F.lit("macro avg").alias("metric_group"), *[F.avg(c).alias(c) for c in means], F.sum("support").alias("support")) \
        .unionByName(out.agg(F.lit("weighted avg").alias("metric_group"), *weighted, F.sum("support").alias("support")))
    acc = pred.agg((F.count_if(F.col("prediction") == F.col("label")) / F.count(F.lit(1))).alias("precision"),
                   F.count(F.lit(1)).alias("support")).select(
        F.lit("accuracy").alias("metric_group"), "precision", F.lit(None).cast("double").alias("recall"),
        F.lit(None).cast("double").alias("f1"), "support")
    auc = None if pred.isEmpty() else BinaryClassificationEvaluator(
        rawPredictionCol="p_positive", labelCol="label", metricName="areaUnderROC",
    ).evaluate(pred.withColumn("label", F.col("label").cast("double")))
    spark = pred.sparkSession
    auc_row = spark.createDataFrame([("roc_auc", None if auc is None else float(auc), None, None, None)],
                                    "metric_group string, precision double, recall double, f1 double, support bigint")
    return out.unionByName(averages).unionByName(acc).unionByName(auc_row)


def feature_importances(model, features: list[str] = MODEL_FEATURES, top: int = 15) -> DataFrame:
    """ML10: importances sorted descending, top 15 (a vector of len(features) numbers)."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    if model is None:
        return spark.createDataFrame([], "feature string, importance double")
    imps = model.featureImportances.toArray().tolist()
    df = spark.createDataFrame(list(zip(features, [float(v) for v in imps])), "feature string, importance double")
    return df.orderBy(F.col("importance").desc(), "feature").limit(top)
