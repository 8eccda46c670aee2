"""Logistic models and classifier evaluation (M1-M8).

Fitting uses MLlib (distributed IRLS / L-BFGS over the feature vectors);
everything around it - feature table, one-hot levels, stratified split,
metrics, confusion matrix - is DataFrame aggregation.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clean as X

Z_975 = 1.959963984540054      # two-sided 95% normal quantile
LOGLOSS_EPS = 2.220446049250313e-16
# Fixed: the features and their order.
BASE_FEATURES = ["age_years", "post_1988", "age_x_post_1988", "MHI_10k", "Pblack",
                 "J40_TotCatExceeded_num", "disadvantaged_num"]


def logit_dataset(df: DataFrame, status_col: str, year_col: str, cur_year: int, key: str | None = None) -> DataFrame:
    """M1: known-status rows, ``target_lead``, age features from a cleaned
    year, ``MHI_10k``, ``Pblack``, J40 count, disadvantaged flag, neighborhood;
    rows without a valid age dropped. Optional columns are used when present."""
    cat = X.normalize_status(status_col)
    y = X.clean_year(year_col, cur_year)
    age = F.lit(float(cur_year)) - y
    post = F.coalesce((y >= 1988).cast("int"), F.lit(0))
    cols = ([F.col(key)] if key else []) + [
        F.when(cat == X.LEAD, 1).otherwise(0).alias("target_lead"),
        age.alias("age_years"), post.alias("post_1988"), (age * post).alias("age_x_post_1988"),
        y.alias("year_built")]
    if "MHI" in df.columns:
        cols.append((X.to_double("MHI") / 10000.0).alias("MHI_10k"))
    if "Pblack" in df.columns:
        cols.append(X.to_double("Pblack").alias("Pblack"))
    if "J40_TotCatExceeded" in df.columns:
        cols.append(X.zero_if_missing_int("J40_TotCatExceeded").alias("J40_TotCatExceeded_num"))
    if "disadvantaged" in df.columns:
        cols.append(X.yes_flag("disadvantaged").alias("disadvantaged_num"))
    if "neighborhood_name" in df.columns:
        cols.append(F.col("neighborhood_name"))
    return df.filter(cat.isin(*X.KNOWN_STATUS)).select(*cols).filter(F.col("age_years").isNotNull())


def one_hot_drop_first(df: DataFrame, col: str, prefix: str = "neigh") -> tuple[DataFrame, list[str]]:
    """M2: dummies for each level but the alphabetically first; null -> all 0.
    The level list is a declared small result (one row per distinct level)."""
    levels = sorted(r[0] for r in df.select(col).filter(F.col(col).isNotNull()).distinct().collect())
    names = []
    for lv in levels[1:]:
        n = f"{prefix}_{lv}"
        df = df.withColumn(n, F.when(F.col(col) == lv, 1).otherwise(0))
        names.append(n)
    return df, names


def model_frame(ds: DataFrame) -> tuple[DataFrame, list[str]]:
    """Features in the fixed order, one-hot neighborhoods, complete cases
    (+-inf treated as missing)."""
    feats = [c for c in BASE_FEATURES if c in ds.columns]
    if "neighborhood_name" in ds.columns:
        ds, dummies = one_hot_drop_first(ds, "neighborhood_name")
        feats += dummies
    keep = [c for c in ds.columns if c not in feats and c != "neighborhood_name"]
    ds = ds.select(*keep, *[X.finite_or_null(F.col(f"`{c}`").cast("double")).alias(c) for c in feats])
    return ds.na.drop(subset=["target_lead"] + feats), feats


def _assemble(ds: DataFrame, feats: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=feats, outputCol=out).transform(ds)


def odds(x: float) -> float:
    """Exp, infinite where a double ends (separated classes)."""
    return math.exp(x) if x < 709.78 else math.inf


class NotConverged(RuntimeError):
    """A fit stopped at its iteration limit."""


def logit_inference(ds: DataFrame, feats: list[str]):
    """M3 + M4: maximum-likelihood logit with intercept (GLM binomial/logit).
    Returns (terms rows, stats dict)."""
    v = _assemble(ds, feats).select("features", F.col("target_lead").cast("double").alias("label"))
    glr = GeneralizedLinearRegression(family="binomial", link="logit", maxIter=100, regParam=0.0, tol=1e-12)
    m = glr.fit(v)
    s = m.summary
    if s.numIterations >= glr.getMaxIter():
        raise NotConverged(f"logit: no convergence in {glr.getMaxIter()} iterations")
    coefs = [m.intercept] + list(m.coefficients)
    se = list(s.coefficientStandardErrors)
    zs = list(s.tValues)
    ps = list(s.pValues)
    # MLlib lists the intercept last
    se, zs, ps = [se[-1]] + se[:-1], [zs[-1]] + zs[:-1], [ps[-1]] + ps[:-1]
    rows = []
    for term, b, e, z, p in zip(["const"] + feats, coefs, se, zs, ps):
        b, e, z, p = float(b), float(e), float(z), float(p)
        lo, hi = b - Z_975 * e, b + Z_975 * e
        rows.append((term, b, e, z, p, lo, hi, odds(b), odds(lo), odds(hi)))
    n = int(s.numInstances)
    k = len(coefs)
    llf = -s.deviance / 2.0
    llnull = -s.nullDeviance / 2.0
    stats = {"n_obs": n, "llf": llf, "llnull": llnull,
             "pseudo_r2_mcfadden": (1 - llf / llnull) if llnull else float("nan"),
             "aic": -2 * llf + 2 * k, "bic": -2 * llf + k * math.log(n)}
    return rows, stats


TERMS_SCHEMA = ("term string, coef double, std_err double, z_value double, p_value double, ci_lower double, "
                "ci_upper double, odds_ratio double, or_ci_lower double, or_ci_upper double")


def arith_hash(key_col: str, seed: int) -> F.Column:
    """Portable hash of an integer key, identical in any SQL engine."""
    return (F.col(key_col) * F.lit(7919) + F.lit(seed * 104729)) % F.lit(1000003)


def stratified_split(df: DataFrame, label: str, key: str, test_frac: float = 0.25, seed: int = 42,
                     bucket_bits: int = 4) -> DataFrame:
    """M5: adds ``is_test``: per class, the ``ceil(test_frac * n_class)`` rows
    with the smallest ``(hash(key, seed), key)`` form the test set.

    No window runs over a whole class: rows are counted per (class, hash
    bucket), cumulative counts come from that small table, and only rows in
    the single bucket where a class crosses its quota are ranked."""
    h = arith_hash(key, seed)
    d = df.withColumn("_h", h).withColumn("_b", F.shiftright(F.col("_h").cast("long"), bucket_bits))
    cnt = d.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(label).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    tot = Window.partitionBy(label)
    cnt = (cnt.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0)))
              .withColumn("_k", F.ceil(F.sum("_n").over(tot) * F.lit(test_frac))))
    d = d.join(F.broadcast(cnt.select(label, "_b", "_n", "_before", "_k")), [label, "_b"])
    edge = (F.col("_before") < F.col("_k")) & (F.col("_before") + F.col("_n") > F.col("_k"))
    wr = Window.partitionBy(label, "_b").orderBy("_h", key)
    ranked = d.filter(edge).withColumn("_r", F.row_number().over(wr) - 1)
    rest = d.filter(~edge).withColumn("_r", F.lit(None).cast("int"))
    u = ranked.unionByName(rest)
    is_test = F.when(F.col("_r").isNotNull(), F.col("_before") + F.col("_r") < F.col("_k")).otherwise(
        F.col("_before") + F.col("_n") <= F.col("_k"))
    return u.withColumn("is_test", is_test).drop("_h", "_b", "_n", "_before", "_k", "_r")


def fit_l2_logistic(train: DataFrame, feats: list[str], C: float = 1.0, max_iter: int = 1000):
    """M6: liblinear-style L2 logistic regression (the intercept is penalised
    too): a constant-1 feature and no separate intercept.

    The library leaves constant features out of a fit. One more row, all
    zeros and of the weight of all others, makes the constant vary; its loss
    does not depend on the coefficients, so only the total weight changes,
    which the penalty 1 / (C * 2n) takes into account."""
    v = _assemble(train.withColumn("_one", F.lit(1.0)), ["_one"] + feats).select(
        "features", F.col("target_lead").cast("double").alias("label"), F.lit(1.0).alias("weight"))
    n = train.count()   # the fit keeps its own blocks of rows; a second copy of them would crowd these out
    zero = train.sparkSession.createDataFrame([(Vectors.sparse(len(feats) + 1, {}), 0.0, float(n))], v.schema)
    lr = LogisticRegression(regParam=1.0 / (C * 2 * n), elasticNetParam=0.0, standardization=False, weightCol="weight",
                            fitIntercept=False, maxIter=max_iter, tol=1e-9)
    m = lr.fit(v.union(zero))
    if m.hasSummary and m.summary.totalIterations >= max_iter:
        raise NotConverged(f"L2 logistic: no convergence in {max_iter} iterations")
    return m


def score(model, df: DataFrame, feats: list[str]) -> DataFrame:
    """Probability of class 1 as ``score`` (vector_to_array, no Python UDF)."""
    from pyspark.ml.functions import vector_to_array
    v = _assemble(df.withColumn("_one", F.lit(1.0)), ["_one"] + feats)
    p = model.transform(v)
    return p.withColumn("score", vector_to_array("probability")[1]).drop("features", "rawPrediction",
                                                                       "probability", "prediction")


def classifier_metrics(scored: DataFrame, label: str = "target_lead", score_col: str = "score",
                       threshold: float = 0.5) -> DataFrame:
    """M7: auc, accuracy, precision, recall, f1 (0 when undefined), log_loss
    (probabilities clipped), brier; ``metric, value`` rows. AUC is exact
    (tie-corrected) from MLlib's evaluator without binning."""
    y = F.col(label).cast("double")
    p = F.col(score_col).cast("double")
    pred = (p > threshold).cast("double")
    pc = F.least(F.greatest(p, F.lit(LOGLOSS_EPS)), F.lit(1 - LOGLOSS_EPS))
    r = scored.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when((pred == 1) & (y == 1), 1).otherwise(0)).alias("tp"),
        F.sum(F.when((pred == 1) & (y == 0), 1).otherwise(0)).alias("fp"),
        F.sum(F.when((pred == 0) & (y == 1), 1).otherwise(0)).alias("fn"),
        F.sum(F.when(pred == y, 1).otherwise(0)).alias("ok"),
        F.avg(-(y * F.log(pc) + (1 - y) * F.log(1 - pc))).alias("ll"),
        F.avg((p - y) * (p - y)).alias("brier")).first()
    ev = BinaryClassificationEvaluator(rawPredictionCol=score_col, labelCol=label,
                                       metricName="areaUnderROC", numBins=0)
    auc = ev.evaluate(scored.select(p.alias(score_col), y.alias(label)))
    tp, fp, fn = r["tp"], r["fp"], r["fn"]
    prec = tp / (tp + fp) if tp + fp else 0.0
    rec = tp / (tp + fn) if tp + fn else 0.0
    f1 = 2 * prec * rec / (prec + rec) if prec + rec else 0.0
    rows = [("auc", float(auc)), ("accuracy", r["ok"] / r["n"]), ("precision", prec), ("recall", rec),
            ("f1", f1), ("log_loss", float(r["ll"])), ("brier", float(r["brier"]))]
    return scored.sparkSession.createDataFrame(rows, "metric string, value double")


def confusion(scored: DataFrame, label: str = "target_lead", score_col: str = "score",
              threshold: float = 0.5) -> DataFrame:
    """M8: rows true_0/true_1, columns pred_0/pred_1 (fixed levels, zero-filled)."""
    pred = (F.col(score_col) > threshold).cast("int")
    g = (scored.withColumn("_t", F.concat(F.lit("true_"), F.col(label).cast("int").cast("string")))
               .groupBy("_t").agg(F.count(F.when(pred == 0, 1)).alias("pred_0"),
                                  F.count(F.when(pred == 1, 1)).alias("pred_1")))
    levels = scored.sparkSession.createDataFrame([("true_0",), ("true_1",)], "_t string")
    return (levels.join(g, "_t", "left").na.fill(0, ["pred_0", "pred_1"])
                  .select(F.col("_t").alias("actual"), "pred_0", "pred_1"))
