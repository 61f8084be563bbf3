"""Cell-rate scorer: the positive rate of each cell of categorical keys,
learned on the training rows. It is a deterministic, SQL-expressible model
used as the baseline scorer and to drive the monitoring tables; the
Spark ML classifiers live in ``models.py``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_rate_model(train: DataFrame, keys: Sequence[str], target: str = "target") -> DataFrame:
    """(keys..., pos, n, rate): one grouped aggregation with partial sums on
    every partition, so a hot cell never gathers its rows in one task."""
    y = F.col(target).cast("double")
    return (train.groupBy(*keys)
                 .agg(F.sum(y).alias("pos"), F.count(F.lit(1)).alias("n"))
                 .withColumn("rate", F.col("pos") / F.col("n")))


def apply_rate_model(df: DataFrame, model: DataFrame, keys: Sequence[str],
                     threshold: float = 0.5) -> DataFrame:
    """Adds y_proba_0, y_proba_1, y_etiqueta; cells unseen in training get
    the global training rate. The model has one row per cell: AQE measures
    it and broadcasts it when under the broadcast threshold (shuffle join
    otherwise). The global rate is derived from the model, not the data."""
    glob = model.agg((F.sum("pos") / F.sum("n")).alias("global_rate")).scalar()
    scored = df.join(model.select(*keys, "rate"), list(keys), "left")
    p1 = F.coalesce(F.col("rate"), glob)
    return (scored.withColumn("y_proba_1", p1)
                  .withColumn("y_proba_0", 1 - F.col("y_proba_1"))
                  .withColumn("y_etiqueta", (F.col("y_proba_1") >= threshold).cast("int"))
                  .drop("rate"))


def rate_precision(df: DataFrame, model: DataFrame, keys: Sequence[str], threshold: float, target: str = "target") -> float:
    """Precision of the scorer on ``df`` (0 if it calls no row positive)."""
    called = apply_rate_model(df, model, keys, threshold).filter(F.col("y_etiqueta") == 1)
    row = called.agg(F.sum(target).alias("tp"), F.count(F.lit(1)).alias("pp")).first()
    return float(row.tp) / row.pp if row.pp else 0.0
