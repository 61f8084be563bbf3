"""Group fairness audit: confusion counts per (attribute, group), absolute
rates, disparities against a reference group and parity (significance is in
``significance``).

Formulas follow the published group-fairness definitions (Saleiro et al.,
"Aequitas: A Bias and Fairness Audit Toolkit", arXiv:1811.05577). All
statistics come from one grouped aggregation over the unpivoted attributes,
so work grows linearly with rows and hot groups are pre-aggregated map-side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.functions.stats import safe_ratio

# metric -> (numerator count, denominator count)
RATES = {
    "prev": ("group_label_pos", "group_size"),
    "pprev": ("pp", "group_size"),
    "fpr": ("fp", "group_label_neg"),
    "fnr": ("fn", "group_label_pos"),
    "tnr": ("tn", "group_label_neg"),
    "tpr": ("tp", "group_label_pos"),
    "for": ("fn", "pn"),
    "fdr": ("fp", "pp"),
    "npv": ("tn", "pn"),
    "precision": ("tp", "pp"),
}
DISPARITY_METRICS = ("ppr", "pprev", "precision", "fdr", "for", "fpr", "fnr", "tpr", "tnr", "npv")
PARITY_TAU = 0.8


def group_crosstab(df: DataFrame, attributes: Sequence[str], score: str = "score",
                   label: str = "label_value") -> DataFrame:
    """tp, fp, tn, fn, pp, pn, label counts and size per (attribute_name,
    attribute_value), plus the attribute totals."""
    unpivot = F.explode(F.array(*[F.struct(F.lit(a).alias("attribute_name"),
                                           F.col(a).cast("string").alias("attribute_value"))
                                  for a in attributes]))
    s, y = F.col(score), F.col(label)
    ind = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")
    counts = (df.select(unpivot.alias("g"), s.alias("_s"), y.alias("_y"))
                .select("g.*", "_s", "_y")
                .groupBy("attribute_name", "attribute_value")
                .agg(ind((F.col("_s") == 1) & (F.col("_y") == 1)).alias("tp"),
                     ind((F.col("_s") == 1) & (F.col("_y") == 0)).alias("fp"),
                     ind((F.col("_s") == 0) & (F.col("_y") == 0)).alias("tn"),
                     ind((F.col("_s") == 0) & (F.col("_y") == 1)).alias("fn"),
                     F.count(F.lit(1)).alias("group_size")))
    w = Window.partitionBy("attribute_name")  # over the aggregated groups only
    return (counts.withColumn("pp", F.col("tp") + F.col("fp"))
                  .withColumn("pn", F.col("tn") + F.col("fn"))
                  .withColumn("group_label_pos", F.col("tp") + F.col("fn"))
                  .withColumn("group_label_neg", F.col("tn") + F.col("fp"))
                  .withColumn("total_entities", F.sum("group_size").over(w))
                  .withColumn("total_pp", F.sum("pp").over(w)))


def group_metrics(xtab: DataFrame) -> DataFrame:
    """Absolute rates per group; a rate without denominator is null."""
    out = xtab.withColumn("ppr", safe_ratio("pp", "total_pp"))
    for m, (num, den) in RATES.items():
        out = out.withColumn(m, safe_ratio(num, den))
    return out


def _with_reference(metrics: DataFrame, ref: DataFrame) -> DataFrame:
    """Attach the reference group's metrics (one row per attribute, broadcast)."""
    cols = [F.col(m).alias(f"ref_{m}") for m in DISPARITY_METRICS]
    counts = [F.col(c).alias(f"ref_{c}") for c in
              ("tp", "fp", "tn", "fn", "pp", "pn", "group_size", "group_label_pos", "group_label_neg")
              if c in ref.columns]
    ref = ref.select("attribute_name", F.col("attribute_value").alias("ref_group_value"), *cols, *counts)
    return metrics.join(F.broadcast(ref), "attribute_name", "left")


def _disparities(df: DataFrame) -> DataFrame:
    for m in DISPARITY_METRICS:
        df = df.withColumn(f"{m}_disparity", safe_ratio(m, f"ref_{m}"))
    return df


def disparity_predefined(metrics: DataFrame, ref_groups: Mapping[str, str]) -> DataFrame:
    """metric / metric of the named reference group of each attribute; null
    when the reference group is absent or its metric is 0."""
    spark = metrics.sparkSession
    refs = spark.createDataFrame(list(ref_groups.items()), "attribute_name string, attribute_value string")
    ref = metrics.join(F.broadcast(refs), ["attribute_name", "attribute_value"])
    return _disparities(_with_reference(metrics, ref))


def disparity_major(metrics: DataFrame) -> DataFrame:
    """Reference = largest group of each attribute (ties -> lowest value)."""
    w = Window.partitionBy("attribute_name").orderBy(F.desc("group_size"),
                                                     F.asc_nulls_last("attribute_value"))
    ref = metrics.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")
    return _disparities(_with_reference(metrics, ref))


def disparity_min(metrics: DataFrame) -> DataFrame:
    """Reference, per metric, = the group with the lowest value of that metric."""
    w = Window.partitionBy("attribute_name")
    out = metrics
    for m in DISPARITY_METRICS:
        out = out.withColumn(f"{m}_disparity", safe_ratio(m, F.min(m).over(w)))
    return out


def parity_flags(disp: DataFrame, metrics: Sequence[str] = DISPARITY_METRICS,
                 tau: float = PARITY_TAU) -> DataFrame:
    """``<metric>_parity``: tau <= disparity <= 1/tau (null if undefined)."""
    out = disp
    for m in metrics:
        d = F.col(f"{m}_disparity")
        out = out.withColumn(f"{m}_parity", F.when(d.isNotNull(), d.between(tau, 1.0 / tau)))
    return out


def parity_attribute(flags: DataFrame, metrics: Sequence[str] = DISPARITY_METRICS) -> DataFrame:
    """An attribute is fair on a metric when all its groups are."""
    return flags.groupBy("attribute_name").agg(
        *[F.bool_and(F.col(f"{m}_parity")).alias(f"{m}_parity") for m in metrics])


def parity_overall(flags: DataFrame, metrics: Sequence[str] = DISPARITY_METRICS) -> DataFrame:
    """Overall fairness per metric and across every metric."""
    per = flags.agg(*[F.bool_and(F.col(f"{m}_parity")).alias(f"{m}_parity") for m in metrics])
    return per.withColumn("overall_parity",
                          F.expr(" AND ".join(f"coalesce({m}_parity, true)" for m in metrics)))


def fairness_table(disp: DataFrame, attribute: str) -> DataFrame:
    """(attribute_value, for, fnr, for_disparity, fnr_disparity) of one attribute."""
    return disp.filter(F.col("attribute_name") == attribute).select(
        "attribute_value", "for", "fnr", "for_disparity", "fnr_disparity")


def fairness_summary(table: DataFrame) -> DataFrame:
    """Worst and best group by FOR and FNR and the unweighted means; ties go
    to the lowest group name (a null group name last)."""
    def arg(metric: str, highest: bool) -> Column:
        key = (-F.col(metric)) if highest else F.col(metric)
        name = F.col("attribute_value")
        pick = F.min(F.when(F.col(metric).isNotNull(),
                            F.struct(key.alias("k"), name.isNull().alias("n"), name.alias("v"))))
        return pick["v"]
    return table.agg(arg("for", True).alias("delegacion_max_FOR"),
                     arg("fnr", True).alias("delegacion_max_FNR"),
                     F.avg("for").alias("promedio_FOR"), F.avg("fnr").alias("promedio_FNR"),
                     arg("for", False).alias("delegacion_min_FOR"),
                     arg("fnr", False).alias("delegacion_min_FNR"))


def confusion_matrix(df: DataFrame, label: str = "y_test", pred: str = "y_etiqueta") -> DataFrame:
    """All four cells (positive class first), zeros included, from one
    aggregation — no pivot of an unknown domain, no cross join."""
    y, p = F.col(label), F.col(pred)
    ind = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")
    wide = df.agg(ind((y == 1) & (p == 1)).alias("tp"), ind((y == 1) & (p == 0)).alias("fn"),
                  ind((y == 0) & (p == 1)).alias("fp"), ind((y == 0) & (p == 0)).alias("tn"))
    cells = [(1, 1, "tp"), (1, 0, "fn"), (0, 1, "fp"), (0, 0, "tn")]
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("y_real"), F.lit(b).alias("y_predicho"), F.col(c).alias("n"))
        for a, b, c in cells])))


def precision_metric(df: DataFrame, label: str = "y_test", pred: str = "y_etiqueta") -> DataFrame:
    """tp / (tp + fp); 0.0 when nothing is predicted positive."""
    y, p = F.col(label), F.col(pred)
    tp = F.sum(F.when((y == 1) & (p == 1), 1).otherwise(0))
    pp = F.sum(F.when(p == 1, 1).otherwise(0))
    return df.agg(F.coalesce(safe_ratio(tp, pp), F.lit(0.0)).alias("precision"),
                  tp.cast("bigint").alias("tp"), pp.cast("bigint").alias("pp"))
