"""Model selection and scoring.

Two families:

* the cell-rate scorer (``scoring.py``), whose k-fold cross-validation is a
  single aggregation: positives and rows per (cell, fold) are summed once,
  and each fold's training rate is total minus that fold — no refit per fold;
* classifiers cross-validated on a hash fold column with every fold score and
  time kept, all on the weighted cells of the discrete features
  (``cell_trees.feature_cells``): logistic regression by Spark ML behind
  StringIndexer + OneHotEncoder + VectorAssembler, forests and boosted trees by
  ``cell_trees``.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.functions.stats import safe_ratio
from vigil.operators import cell_trees as CT
from vigil.operators.features import digest_bucket
from vigil.session import cut_lineage, materialize

def fold_column(key: str, folds: int, seed: int = 0, method: str = "hash"):
    if method == "hash":
        return F.pmod(F.xxhash64(F.col(key), F.lit(seed + 1)), F.lit(folds)).cast("int")
    return digest_bucket(key, folds, f"fold{seed}")


# ---- cell-rate model cross-validation ----------------------------------------------
def cv_rate_model(df: DataFrame, grid: Mapping[str, tuple[Sequence[str], float]], fold: str,
                  folds: int, target: str = "target") -> DataFrame:
    """Fold precision of every (key set, threshold) of ``grid``.

    For fold k a cell's training rate is (pos_total - pos_k) / (n_total - n_k)
    (the global rate without fold k if the cell has no other rows); all rows
    of a (cell, fold) share a prediction, so tp and pp come from the
    aggregated table. The data is read once: it is summed per (every key of
    the grid, fold) — a table bounded by the product of the key domains —
    and one pass over that table serves all grid entries."""
    y = F.col(target).cast("double")
    all_keys = sorted({k for keys, _ in grid.values() for k in keys})
    # the sufficient statistics of every grid entry, checkpointed once in the
    # shared folder so the entries below never re-read the data
    base = cut_lineage(df.groupBy(*all_keys, fold)
                         .agg(F.sum(y).alias("_pos"), F.count(F.lit(1)).alias("_n")))
    per_fold = base.groupBy(fold).agg(F.sum("_pos").alias("P_f"), F.sum("_n").alias("N_f"))
    all_w = Window.partitionBy(F.lit(0))  # over `folds` rows only
    glob = per_fold.select(fold, safe_ratio(F.sum("P_f").over(all_w) - F.col("P_f"),
                                            F.sum("N_f").over(all_w) - F.col("N_f")).alias("grate"))
    # a cell of every entry of the grid at once: its name, threshold and key values
    entries = F.array(*[F.struct(F.lit(name).alias("params"), F.lit(float(threshold)).alias("threshold"),
                                 F.array(*[F.col(k).cast("string") for k in keys]).alias("cell"))
                        for name, (keys, threshold) in grid.items()])
    cells = (base.select(fold, "_pos", "_n", F.explode(entries).alias("e")).select(fold, "_pos", "_n", "e.*")
             .groupBy("params", "threshold", "cell", fold).agg(F.sum("_pos").alias("pos_f"), F.sum("_n").alias("n_f")))
    w = Window.partitionBy("params", "cell")  # over the aggregated cells, not the rows
    cells = (cells.withColumn("pos_t", F.sum("pos_f").over(w)).withColumn("n_t", F.sum("n_f").over(w))
                  .join(F.broadcast(glob), fold))
    rate = F.coalesce(safe_ratio(F.col("pos_t") - F.col("pos_f"), F.col("n_t") - F.col("n_f")), F.col("grate"))
    pred = rate >= F.col("threshold")
    out = (cells.groupBy("params", fold)
                .agg(F.sum(F.when(pred, F.col("pos_f")).otherwise(0)).alias("tp"),
                     F.sum(F.when(pred, F.col("n_f")).otherwise(0)).alias("pp"))
                .select("params", fold, F.coalesce(safe_ratio("tp", "pp"), F.lit(0.0)).alias("score")))
    return cv_table(out, fold, folds)


def cv_table(scores: DataFrame, fold: str, folds: int) -> DataFrame:
    """(params, fold, score) -> params, split0..split{k-1}_test_score,
    mean_test_score, std_test_score (population), rank_test_score (ties share
    the lowest rank). Pivot values are the known fold ids. With fit_time and
    score_time (seconds) their means and deviations over the folds come first."""
    times = [c for c in ("fit_time", "score_time") if c in scores.columns]
    splits = [F.max(F.when(F.col(fold) == k, F.col("score"))).alias(f"split{k}_test_score") for k in range(folds)]
    spent = [a for c in times for a in (F.avg(c).alias(f"mean_{c}"), F.stddev_pop(c).alias(f"std_{c}"))]
    wide = scores.groupBy("params").agg(*spent, *splits)
    cols = [F.col(f"split{k}_test_score") for k in range(folds)]
    mean = sum(cols[1:], cols[0]) / folds
    wide = wide.withColumn("mean_test_score", mean)
    var = sum([(c - F.col("mean_test_score")) ** 2 for c in cols[1:]],
              (cols[0] - F.col("mean_test_score")) ** 2) / folds
    wide = wide.withColumn("std_test_score", F.sqrt(var))
    w = Window.orderBy(F.desc("mean_test_score"))  # one row per grid entry
    return wide.withColumn("rank_test_score", F.rank().over(w).cast("int"))


def best_model(results: DataFrame, score: str = "mean_test_score", name: str = "params") -> DataFrame:
    """Highest mean score; null/NaN scores never win; ties -> lowest name.
    Planned as a top-1 (TakeOrderedAndProject), not a sort."""
    s = F.col(score).cast("double")
    return (results.filter(s.isNotNull() & ~F.isnan(s))
                   .orderBy(s.desc(), F.col(name).asc()).limit(1))


def model_ranking(results: DataFrame) -> DataFrame:
    return results.orderBy(F.asc("rank_test_score"), F.asc("params"))


# ---- Spark ML and cell trees ---------------------------------------------------------
def feature_stages(categorical: Sequence[str], numeric: Sequence[str]):
    """Indexers fitted on the training data only (alphabetical levels, unseen
    levels kept in an extra bucket), one-hot vectors, assembler."""
    idx = [f"{c}__idx" for c in categorical]
    ohe = [f"{c}__ohe" for c in categorical]
    return [StringIndexer(inputCols=list(categorical), outputCols=idx, handleInvalid="keep",
                          stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCols=idx, outputCols=ohe, handleInvalid="keep", dropLast=True),
            VectorAssembler(inputCols=list(numeric) + ohe, outputCol="features",
                            handleInvalid="keep")]


#: Spark ML's own trees are fitted on rows where there are too many cells for
#: ``cell_trees``; they are at most 30 deep and have no least size of a split.
ML_MAX_DEPTH = 30
#: Folds of small fits (linear models) that run side by side: each fit is a long
#: row of short jobs, which leave cores idle one fold at a time.
FOLDS_AT_ONCE = 3


def classifier(kind: str, label: str = "target", weight: str | None = None):
    if kind == "logistic":
        est = LogisticRegression(featuresCol="features", labelCol=label, standardization=False, maxIter=100)
    elif kind == "random_forest":
        # cacheNodeIds: node ids are cached instead of walking the trees again
        est = RandomForestClassifier(featuresCol="features", labelCol=label, seed=0, featureSubsetStrategy="sqrt",
                                     cacheNodeIds=True)
    elif kind in ("gbt", "gbt_single"):
        est = GBTClassifier(featuresCol="features", labelCol=label, seed=0)
    else:
        raise ValueError(kind)
    return est.setWeightCol(weight) if weight else est


def param_grid(kind: str, n_train: int, est) -> list[tuple[str, dict]]:
    """The settings of a kind of model by name, as Spark ML parameters.

    * logistic: penalty {l1, l2} x C {0.5, 1, 1.5}; regParam = 1 / (C n),
      elasticNetParam 1 for l1, 0 for l2;
    * random forest: 50 trees x depth {50, 100} x least split {10, 25} x least
      leaf {10, 20} x square root of the columns;
    * gbt: 100 trees x rate 0.25 x all rows x depth {10, 15}; gbt_single: one.
    """
    if kind == "logistic":
        return [(f"penalty={pen},C={c}", {est.regParam: 1.0 / (c * max(n_train, 1)), est.elasticNetParam: 1.0 if pen == "l1" else 0.0})
                for pen in ("l1", "l2") for c in (0.5, 1.0, 1.5)]
    out = []
    for name, s in CT.tree_grid(kind):
        params = {est.maxDepth: min(s["max_depth"], ML_MAX_DEPTH)}
        if kind == "random_forest":
            params |= {est.numTrees: s["n_estimators"], est.minInstancesPerNode: s["min_samples_leaf"]}
        else:
            params |= {est.maxIter: s["n_estimators"], est.stepSize: s["learning_rate"]}
        out.append((name, params))
    return out


def precision_of(pred: DataFrame, label: str = "target", weight: str | None = None) -> float:
    w = F.col(weight) if weight else F.lit(1)
    row = pred.agg(F.sum(F.when((F.col("prediction") == 1) & (F.col(label) == 1), w).otherwise(0)).alias("tp"),
                   F.sum(F.when(F.col("prediction") == 1, w).otherwise(0)).alias("pp")).first()
    return float(row.tp) / row.pp if row.pp else 0.0


def weighted_rows(cells: DataFrame, n, pos, categorical: Sequence[str], numeric: Sequence[str], label: str) -> DataFrame:
    """A row per cell and label with its count: an estimator with a weight
    column minimises the same objective as on the rows themselves."""
    pair = F.array(F.struct(F.lit(1.0).alias(label), pos.cast("double").alias("_weight")),
                   F.struct(F.lit(0.0).alias(label), (n - pos).cast("double").alias("_weight")))
    return cells.select(*categorical, *numeric, F.explode(pair).alias("_p")).select(
        *categorical, *numeric, "_p.*").filter(F.col("_weight") > 0)


def _fold_scores(spark: SparkSession, cells: DataFrame, kind: str, categorical: Sequence[str], numeric: Sequence[str],
                 folds: int, label: str, parallelism: int) -> list[tuple]:
    """Spark ML fits: the encoded cells of FOLDS_AT_ONCE folds are held at a time
    (and given back if a fit fails), the settings of a fold are fitted side by side.
    With a ``parallelism`` of one, one fit runs at a time."""
    est = classifier(kind, label, "_weight")
    all_n = sum((F.col("n")[k] for k in range(1, folds)), F.col("n")[0])
    all_pos = sum((F.col("pos")[k] for k in range(1, folds)), F.col("pos")[0])

    def fold(k: int) -> list[tuple]:
        n, pos = F.col("n")[k], F.col("pos")[k]
        train = weighted_rows(cells, all_n - n, all_pos - pos, categorical, numeric, label)
        feat = Pipeline(stages=feature_stages(categorical, numeric)).fit(train)
        tr = feat.transform(train).select("features", label, "_weight").persist(StorageLevel.MEMORY_AND_DISK)
        va = feat.transform(weighted_rows(cells, n, pos, categorical, numeric, label)).select(
            "features", label, "_weight").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            n_train = int(tr.agg(F.sum("_weight")).first()[0] or 0)
            if not n_train:
                return []

            def run(setting):
                began = time.perf_counter()
                model = est.copy(setting[1]).fit(tr)
                fitted = time.perf_counter()
                score = precision_of(model.transform(va), label, "_weight")
                return setting[0], k, score, fitted - began, time.perf_counter() - fitted

            with ThreadPoolExecutor(max_workers=parallelism) as pool:
                return list(pool.map(run, param_grid(kind, n_train, est)))
        finally:
            tr.unpersist()
            va.unpersist()

    with ThreadPoolExecutor(max_workers=FOLDS_AT_ONCE if parallelism > 1 else 1) as pool:
        return [row for rows in pool.map(fold, range(folds)) for row in rows]


def cross_validate_ml(df: DataFrame, kind: str, categorical: Sequence[str], numeric: Sequence[str],
                      key: str = "folio", folds: int = 10, label: str = "target",
                      parallelism: int = 8, method: str = "hash") -> DataFrame:
    """k-fold grid search keeping every fold's precision, fit time and score time.

    Rows are compressed to weighted cells once. Trees are grown by
    ``cell_trees``, a task per (setting, fold); logistic regressions (and trees,
    where there are more cells than a task may hold) are fitted by Spark ML."""
    spark: SparkSession = df.sparkSession
    cells = CT.feature_cells(df.withColumn("_fold", fold_column(key, folds, method=method)), categorical, numeric,
                             label, "_fold", folds)
    if kind in CT.FITS and cells.count() <= CT.MAX_CELLS:
        scores = materialize(CT.cross_validate(cells, kind, categorical, numeric, folds), "cv-scores")
        scores = scores.withColumn("score", F.coalesce(safe_ratio("tp", "pp"), F.lit(0.0)))
    else:
        # linear models are small; fitted trees are held by the driver, so one at a time
        rows = _fold_scores(spark, cells, kind, categorical, numeric, folds, label, parallelism if kind == "logistic" else 1)
        scores = spark.createDataFrame(rows, "params string, _fold int, score double, fit_time double, score_time double")
    return cv_table(scores, "_fold", folds).withColumn("modelo", F.lit(kind))


def fit_best(df: DataFrame, kind: str, params: str, categorical: Sequence[str],
             numeric: Sequence[str], label: str = "target") -> PipelineModel | CT.CellModel:
    """The chosen setting fitted on all rows of ``df``."""
    if kind in CT.FITS:
        return CT.CellModel.fit(df, kind, dict(CT.tree_grid(kind))[params], categorical, numeric, label)
    est = classifier(kind, label, "_weight")
    cells = CT.feature_cells(df, categorical, numeric, label)
    data = weighted_rows(cells, F.col("n")[0], F.col("pos")[0], categorical, numeric, label)
    n_train = int(data.agg(F.sum("_weight")).first()[0] or 0)
    grid = dict(param_grid(kind, n_train, est))
    return Pipeline(stages=feature_stages(categorical, numeric) + [est.copy(grid[params])]).fit(data)


def score(model: PipelineModel | CT.CellModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """y_proba_0, y_proba_1 and y_etiqueta beside the columns ``keep``."""
    if isinstance(model, CT.CellModel):
        return model.transform(df).select(*keep, "y_proba_0", "y_proba_1", "y_etiqueta")
    out = model.transform(df)
    p = vector_to_array(F.col("probability"))
    return out.select(*keep, p[0].alias("y_proba_0"), p[1].alias("y_proba_1"),
                      F.col("prediction").cast("int").alias("y_etiqueta"))


def save_model(model: PipelineModel | CT.CellModel, path: str) -> None:
    if isinstance(model, CT.CellModel):
        model.save(SparkSession.getActiveSession(), path)
    else:
        model.write().overwrite().save(path)


def load_model(path: str, kind: str = "logistic") -> PipelineModel | CT.CellModel:
    """The stored model; its kind is that of its registry row."""
    return CT.CellModel.load(SparkSession.getActiveSession(), path) if kind in CT.FITS else PipelineModel.load(path)
