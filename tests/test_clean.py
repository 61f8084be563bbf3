import json

from pyspark.sql import functions as F

from vigil.catalog import RAW_FIELDS
from vigil.functions.temporal import closed_month
from tests.test_text_properties import nfkd_ascii
from vigil.functions.text import ascii_fold, unaccent
from vigil.operators import clean as C


def _raw(spark, docs):
    return spark.createDataFrame([(json.dumps(d),) for d in docs], "registros string")


def test_time_filter_rejects_null_and_no_colon(spark):
    docs = [{"folio": "1", "hora_creacion": "08:15:00"}, {"folio": "2", "hora_creacion": "0.5"},
            {"folio": "3"}]
    out = C.clean_incidents(C.parse_documents(_raw(spark, docs)))
    assert [r.folio for r in out.collect()] == ["1"]


def test_absent_json_key_is_null(spark):
    out = C.json_extract(_raw(spark, [{"a": "x"}]), ["a", "missing"]).first()
    assert out.a == "x" and out.missing is None


def test_clean_composition(spark):
    docs = [{"folio": "1", "hora_creacion": "08:15:00", "delegacion_inicio": "N/A",
             "dia_semana": "Miércoles", "tipo_entrada": "LLAMADA DEL 066",
             "incidente_c4": "Detención ciudadana-Atropellado", "codigo_cierre": "(A) Confirmó.",
             "mes": "4", "ano": "2020", "latitud": 19.4, "longitud": -99.1}]
    r = C.clean_incidents(C.parse_documents(_raw(spark, docs))).first()
    assert r.delegacion_inicio == "na"
    assert r.dia_semana == "miercoles"
    assert r.tipo_entrada == "llamada del 066"
    assert r.incidente_c4 == "detencion ciudadana-atropellado"
    assert r.codigo_cierre == "(a) confirmo"
    assert (r.mes, r.ano) == (4, 2020)


def test_delegacion_keeps_accents_but_loses_points(spark):
    docs = [{"folio": "1", "hora_creacion": "08:15:00", "delegacion_inicio": "ÁLVARO. OBREGÓN, N/A"}]
    r = C.clean_incidents(C.parse_documents(_raw(spark, docs))).first()
    assert r.delegacion_inicio == "álvaro obregón na"


def test_target_null_code_is_zero(spark):
    df = spark.createDataFrame([("(a) x",), ("(n) y",), (None,)], "codigo_cierre string")
    assert [r.target for r in C.label_target(df).collect()] == [1, 0, 0]


def test_hour_and_category(spark):
    df = spark.createDataFrame([("08:15:00", "accidente-choque")], "hora_creacion string, incidente_c4 string")
    r = C.preprocess(df.withColumn("codigo_cierre", F.lit(None).cast("string"))).first()
    assert r.hora == 8 and r.incidente_c4_rec == "accidente"


def _share_df(spark, n_na, n):
    rows = [("na",)] * n_na + [("x",)] * (n - n_na)
    return spark.createDataFrame(rows, "delegacion_inicio string")


def test_guarded_drop_threshold(spark):
    # 2.9 % dropped, 3.0 % and 3.1 % kept (strictly below the limit drops)
    assert C.guarded_drop(_share_df(spark, 29, 1000)).count() == 971
    assert C.guarded_drop(_share_df(spark, 30, 1000)).count() == 1000
    assert C.guarded_drop(_share_df(spark, 31, 1000)).count() == 1000


def test_guarded_drop_empty_keeps_schema(spark):
    empty = spark.createDataFrame([], "delegacion_inicio string, x int")
    out = C.guarded_drop(empty)
    assert out.count() == 0 and out.columns == ["delegacion_inicio", "x"]


def test_closed_month(spark):
    df = spark.createDataFrame([("2020-01-10",), ("2020-01-20",), ("2020-03-31",)], "d string")
    got = [str(r.m) for r in df.select(closed_month(F.to_date("d")).alias("m")).collect()]
    assert got == ["2019-11-01", "2019-12-01", "2020-02-01"]


def test_unaccent_and_fold_differ_on_purpose(spark):
    text = "Ça déjà Straße Æsir Øre ñandú"
    df = spark.createDataFrame([(text,)], "t string")
    r = df.select(unaccent("t").alias("u"), ascii_fold("t").alias("a")).first()
    assert r.u == "Ca deja Strasse AEsir Ore nandu"
    assert r.a == nfkd_ascii(text)


def test_fold_matches_nfkd_on_documents(spark):
    from tests.conftest import SF
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = docs.select("text", ascii_fold("text").alias("a")).collect()
    assert all(nfkd_ascii(r.text) == r.a for r in rows)


def test_raw_schema_has_geopoint():
    assert "geopoint" in RAW_FIELDS.fieldNames()


def test_monthly_clean_equals_slice_of_full_clean(spark):
    from tests.conftest import SF
    from vigil.plans.frames import clean_table, clean_table_from_raw, parsed_incidents
    full = clean_table_from_raw(spark, SF)
    parsed = parsed_incidents(spark, SF)
    months = [(r.ano, r.mes) for r in full.select("ano", "mes").distinct().orderBy("ano", "mes").limit(3).collect()]
    for y, m in months:
        a = sorted(tuple(r) for r in C.clean_month(parsed, y, m).collect())
        b = sorted(tuple(r) for r in full.filter((F.col("ano") == y) & (F.col("mes") == m)).collect())
        assert a == b and a
    # the analytic frame (no JSON round trip) holds the same rows
    assert sorted(tuple(r) for r in clean_table(spark, SF).collect()) == \
        sorted(tuple(r) for r in full.collect())
