"""Query keys: split, imputation, one-hot encoding, alignment, inverse (M1-M5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil.operators import features as FE
from vigil.plans.frames import processed_table, written_split
from vigil.plans.registry import register
from vigil.plans.sql import with_scored

NUMS = ("mes", "hora")
CATS = ("delegacion_inicio", "dia_semana", "tipo_entrada", "incidente_c4_rec")
# Category domains of the incident mapping (fixed values, used by the SQL twins).
DOMAINS = {
    "delegacion_inicio": tuple(sorted(f"á nation_{k}" for k in range(25))),
    "dia_semana": ("domingo", "jueves", "lunes", "martes", "miercoles", "sabado", "viernes"),
    "tipo_entrada": ("llamada automobile", "llamada building", "llamada furniture",
                     "llamada household", "llamada machinery"),
    "incidente_c4_rec": ("accidente", "cadaver", "detencion ciudadana", "lesionado", "sismo"),
}


def _dummies_sql(src, extra=""):
    cols = ", ".join(f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS \"{c}_{v}\""
                     for c, vs in DOMAINS.items() for v in vs)
    return f"SELECT folio, {extra}mes, hora, {cols} FROM {src}"


def _sets(spark, d):
    s = written_split(spark, d)
    return s.filter(F.col("conjunto") == "train"), s.filter(F.col("conjunto") == "test")


@register("train_test_split", with_scored("SELECT folio, conjunto FROM split"))
def q_train_test_split(spark, d):
    return written_split(spark, d).select("folio", "conjunto")


@register("impute_mode", with_scored("""
, md AS (SELECT delegacion_inicio AS moda FROM split WHERE conjunto = 'train' AND delegacion_inicio IS NOT NULL
         GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT folio, conjunto, coalesce(delegacion_inicio, (SELECT moda FROM md)) AS delegacion_inicio FROM split
WHERE conjunto IN ('train', 'test')"""))
def q_impute_mode(spark, d):
    train, test = _sets(spark, d)
    tr, te = FE.impute_mode(train, test, ["delegacion_inicio"])
    return tr.unionByName(te).select("folio", "conjunto", "delegacion_inicio")


# all sets with the borough imputed by the training mode
IMPUTED = """
, im AS (SELECT * REPLACE (coalesce(delegacion_inicio, (SELECT moda FROM moda)) AS delegacion_inicio) FROM split)"""


def _imputed(spark, d):
    s = written_split(spark, d)
    train = s.filter(F.col("conjunto") == "train")
    out = FE.fill_with(s, FE.fit_modes(train, ["delegacion_inicio"]), ["delegacion_inicio"])
    return out.select("folio", "conjunto", *NUMS, *CATS)


def _encoded(spark, d):
    s = _imputed(spark, d)
    vocab = FE.fit_one_hot(s.filter(F.col("conjunto") == "train"), CATS)
    both = s.filter(F.col("conjunto").isin("train", "test"))
    return FE.one_hot(both, vocab, keep=["folio", "conjunto", *NUMS]), vocab


@register("one_hot", with_scored(
    IMPUTED + ", b AS (SELECT * FROM im WHERE conjunto IN ('train', 'test'))\n" + _dummies_sql("b", "conjunto, ")))
def q_one_hot(spark, d):
    return _encoded(spark, d)[0]


@register("one_hot_long", with_scored(IMPUTED + ", " + ", ".join(
    f"l{i} AS (SELECT folio, '{c}' AS variable, {c} AS level FROM im WHERE conjunto IN ('test', 'nuevo') AND {c} IN "
    f"(SELECT {c} FROM im WHERE conjunto = 'train'))" for i, c in enumerate(CATS))
    + "\n" + " UNION ALL ".join(f"SELECT * FROM l{i}" for i in range(len(CATS)))))
def q_one_hot_long(spark, d):
    s = _imputed(spark, d)
    levels = FE.fit_levels(s.filter(F.col("conjunto") == "train"), CATS)
    return FE.one_hot_long(s.filter(F.col("conjunto").isin("test", "nuevo")), levels, CATS, keep=["folio"])


@register("align_features", with_scored(
    IMPUTED + ", mo AS (SELECT * FROM im WHERE conjunto = 'nuevo')\n" + _dummies_sql("mo")))
def q_align_features(spark, d):
    s = _imputed(spark, d)
    train, month = s.filter(F.col("conjunto") == "train"), s.filter(F.col("conjunto") == "nuevo")
    train_cols = FE.one_hot(train, FE.fit_one_hot(train, CATS), keep=NUMS).columns
    # the month is encoded on its own (as delivered), then aligned by name
    month_encoded = FE.one_hot(month, FE.fit_one_hot(month, CATS), keep=["folio", *NUMS])
    return FE.align_features(month_encoded, train_cols, keep=["folio"])


@register("one_hot_inverse", with_scored(
    IMPUTED + "\nSELECT folio, conjunto, mes, hora, delegacion_inicio, dia_semana, tipo_entrada, incidente_c4_rec "
    "FROM im WHERE conjunto IN ('train', 'test')"))
def q_one_hot_inverse(spark, d):
    encoded, vocab = _encoded(spark, d)
    return FE.one_hot_inverse(encoded, vocab, keep=["folio", "conjunto", *NUMS])


@register("unseen_levels", with_scored(", " + ", ".join(
    f"u{i} AS (SELECT '{c}' AS variable, {c} AS level, count(*) AS n FROM proc WHERE {c} IS NOT NULL AND {c} NOT IN "
    f"(SELECT {c} FROM split WHERE conjunto = 'train' AND {c} IS NOT NULL) GROUP BY {c})" for i, c in enumerate(CATS))
    + "\n" + " UNION ALL ".join(f"SELECT * FROM u{i}" for i in range(len(CATS)))))
def q_unseen_levels(spark, d):
    """Levels of all processed rows that the encoder of the training rows drops
    (the rows without a borough are not in the population)."""
    levels = FE.fit_levels(written_split(spark, d).filter(F.col("conjunto") == "train"), CATS)
    return FE.unseen_levels(processed_table(spark, d), levels, CATS)
