import pytest
from pyspark.sql import functions as F

from vigil.operators import fairness as B

# Golden rows of the reference's fairness table (group, FOR, FNR, FOR
# disparity, FNR disparity), reference group iztapalapa (fixed values).
GOLDEN = [
    ("alvaro obregon", 0.3868305341310459, 0.9123597415844951, 1.0580688460330196, 1.0178254847111121),
    ("azcapotzalco", 0.43066241321073373, 0.8581577963355353, 1.1779589312908527, 0.9573579753715427),
    ("benito juarez", 0.4146515234063954, 0.682721501518079, 1.1341655328785671, 0.7616418300072286),
    ("coyoacan", 0.4034532182260591, 0.9023408379305203, 1.1035356399558176, 1.0066484292108653),
    ("cuajimalpa", 0.33533260632497275, 0.9111111111111111, 0.9172103867356866, 1.0164325167195718),
    ("cuauhtemoc", 0.4513501549358123, 0.7328222328701486, 1.234544575604721, 0.8175340388022381),
    ("gustavo a madero", 0.42042354163959983, 0.8723782822019733, 1.1499533059017257, 0.9732223019744437),
    ("iztacalco", 0.4109813697192338, 0.847767253044655, 1.1241268339292663, 0.9457663199318965),
    ("iztapalapa", 0.36560053306679996, 0.8963813102434243, 1.0, 1.0),
    ("magdalena contreras", 0.3690939410783769, 0.9034013605442177, 1.009555259622498, 1.0078315447015367),
    ("miguel hidalgo", 0.42692344666260773, 0.8810342547282105, 1.1677320136308533, 0.9828788760543813),
    ("milpa alta", 0.454337899543379, 0.8274428274428275, 1.2427167316530296, 0.9230924585187127),
    ("tlahuac", 0.39508700102354144, 0.8728643216080402, 1.0806521470562351, 0.9737645259147608),
    ("tlalpan", 0.3873539694721583, 0.9160112925993144, 1.0595005598675746, 1.021899142844198),
    ("venustiano carranza", 0.4214677071226963, 0.8272097759674134, 1.1528093342404637, 0.9228324670700392),
    ("xochimilco", 0.3595747737394053, 0.9024698034973859, 0.9835181877968058, 1.0067923027671206),
]


def test_golden_disparities_and_summary(spark):
    df = spark.createDataFrame([(g, f, n) for g, f, n, _, _ in GOLDEN],
                               "attribute_value string, for double, fnr double")
    metrics = df.withColumn("attribute_name", F.lit("delegacion_inicio"))
    for m in B.DISPARITY_METRICS:
        if m not in ("for", "fnr"):
            metrics = metrics.withColumn(m, F.lit(None).cast("double"))
    disp = B.disparity_predefined(metrics, {"delegacion_inicio": "iztapalapa"})
    got = {r.attribute_value: r for r in B.fairness_table(disp, "delegacion_inicio").collect()}
    for g, f, n, fd, nd in GOLDEN:
        assert got[g].for_disparity == pytest.approx(fd, rel=1e-12)
        assert got[g].fnr_disparity == pytest.approx(nd, rel=1e-12)
    s = B.fairness_summary(B.fairness_table(disp, "delegacion_inicio")).first()
    assert s.delegacion_max_FOR == "milpa alta" and s.delegacion_min_FOR == "cuajimalpa"
    assert s.delegacion_max_FNR == "tlalpan" and s.delegacion_min_FNR == "benito juarez"
    assert s.promedio_FOR == pytest.approx(0.4020702895814261, rel=1e-12)
    assert s.promedio_FNR == pytest.approx(0.8591546064517095, rel=1e-12)


def _audit(spark, rows):
    return spark.createDataFrame(rows, "g string, score int, label_value int")


def test_zero_denominators_give_null(spark):
    # group b: every prediction positive -> fn + tn = 0 -> FOR null
    rows = [("a", 0, 1), ("a", 0, 0), ("a", 1, 1), ("b", 1, 1), ("b", 1, 0)]
    m = {r.attribute_value: r for r in B.group_metrics(B.group_crosstab(_audit(spark, rows), ["g"])).collect()}
    assert m["b"]["for"] is None
    assert m["a"]["for"] == pytest.approx(0.5)
    # reference group with metric 0 -> disparity null; absent reference -> null
    rows = [("a", 0, 0), ("a", 1, 1), ("b", 0, 1), ("b", 0, 0)]
    met = B.group_metrics(B.group_crosstab(_audit(spark, rows), ["g"]))
    d = {r.attribute_value: r for r in B.disparity_predefined(met, {"g": "a"}).collect()}
    assert d["b"]["for_disparity"] is None  # FOR of a is 0
    d2 = {r.attribute_value: r for r in B.disparity_predefined(met, {"g": "zzz"}).collect()}
    assert d2["a"]["fnr_disparity"] is None


def test_group_confusion_sums_to_total(spark):
    from tests.conftest import SF
    from vigil.plans.frames import historic_predictions
    h = historic_predictions(spark, SF)
    xt = B.group_crosstab(h.select("delegacion_inicio", "tipo_entrada", F.col("y_etiqueta").alias("score"),
                                   F.col("y_test").alias("label_value")), ["delegacion_inicio", "tipo_entrada"])
    per = xt.groupBy("attribute_name").agg(F.sum("tp").alias("tp"), F.sum("fn").alias("fn")).collect()
    total = {r.n for r in B.confusion_matrix(h).filter("y_real = 1 AND y_predicho = 1").collect()}
    assert {r.tp for r in per} == total


def test_precision_zero_without_positives(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "y_test int, y_etiqueta int")
    assert B.precision_metric(df).first().precision == 0.0
