"""Query keys: parsing, typing, cleaning and labelling (P, F1-F3, T)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil.catalog import table
from vigil.functions.text import ascii_fold, remove_points, sql_ascii_fold, sql_remove_points
from vigil.functions.text import sql_unaccent, standardize_name, unaccent
from vigil.operators import clean as C
from vigil.operators.quarantine import clean_or_reject
from vigil.plans.frames import (clean_table, clean_table_from_raw, incident_source,
                                parsed_incidents, processed_table)
from vigil.plans.frames import raw_documents
from vigil.plans.registry import register
from vigil.plans.sql import with_clean, with_inc, with_proc

# Month sliced by the monthly clean (the month parameter of the monthly run).
MONTH_YEAR, MONTH_NUM = 1996, 4


@register("json_extract", with_inc("""
SELECT folio, hora_creacion, delegacion_inicio, mes, ano, codigo_cierre,
       CAST(NULL AS varchar) AS clave_ausente FROM inc"""))
def q_json_extract(spark, d):
    keys = ["folio", "hora_creacion", "delegacion_inicio", "mes", "ano", "codigo_cierre",
            "clave_ausente"]
    return C.json_extract(raw_documents(spark, d), keys)


@register("typed_cast", with_inc("""
SELECT folio, cast(mes AS smallint) AS mes, cast(ano AS integer) AS ano,
       cast(latitud AS double) AS latitud, cast(longitud AS double) AS longitud,
       cast(concat(ano, '-', lpad(mes, 2, '0'), '-01') AS date) AS fecha
FROM inc"""))
def q_typed_cast(spark, d):
    df = parsed_incidents(spark, d)
    df = df.withColumn("fecha", F.to_date(F.concat_ws("-", "ano", F.lpad("mes", 2, "0"), F.lit("01"))))
    typed = C.cast_columns(df, {"mes": "smallint", "ano": "int", "latitud": "double",
                                "longitud": "double"})
    return typed.select("folio", "mes", "ano", "latitud", "longitud", "fecha")


@register("clean_text", """
SELECT doc_id, lower(text) AS text_lower, lower(source) AS source_lower FROM documents""")
def q_clean_text(spark, d):
    docs = table(spark, d, "documents", spread=True).select("doc_id", "text", "source")
    out = C.lower_columns(docs, "text", "source")
    return out.select("doc_id", F.col("text").alias("text_lower"), F.col("source").alias("source_lower"))


@register("remove_points", f"""
SELECT doc_id, {sql_remove_points('text')} AS text_no_points,
       {sql_remove_points('text', '.')} AS text_no_dots FROM documents""")
def q_remove_points(spark, d):
    docs = table(spark, d, "documents", spread=True)
    return docs.select("doc_id", remove_points("text").alias("text_no_points"),
                       remove_points("text", ".").alias("text_no_dots"))


@register("unaccent", f"SELECT doc_id, lang, {sql_unaccent('text')} AS text_unaccent FROM documents")
def q_unaccent(spark, d):
    docs = table(spark, d, "documents", spread=True)
    return docs.select("doc_id", "lang", unaccent("text").alias("text_unaccent"))


@register("ascii_fold", f"SELECT doc_id, lang, {sql_ascii_fold('text')} AS text_ascii FROM documents")
def q_ascii_fold(spark, d):
    docs = table(spark, d, "documents", spread=True)
    return docs.select("doc_id", "lang", ascii_fold("text").alias("text_ascii"))


@register("clean_incidents", with_clean("SELECT * FROM clean"))
def q_clean_incidents(spark, d):
    return clean_table_from_raw(spark, d)


@register("recategorize", with_proc("SELECT folio, incidente_c4, incidente_c4_rec FROM proc"))
def q_recategorize(spark, d):
    return C.recategorize(clean_table(spark, d)).select("folio", "incidente_c4", "incidente_c4_rec")


@register("hour_of_day", with_proc("SELECT folio, hora_creacion, hora FROM proc"))
def q_hour_of_day(spark, d):
    return C.hour_of_day(clean_table(spark, d)).select("folio", "hora_creacion", "hora")


@register("label_target", with_proc("SELECT folio, codigo_cierre, clave, target FROM proc"))
def q_label_target(spark, d):
    return C.label_target(clean_table(spark, d)).select("folio", "codigo_cierre", "clave", "target")


@register("valid_time_filter", with_inc(
    "SELECT folio, hora_creacion FROM inc WHERE contains(hora_creacion, ':')"))
def q_valid_time_filter(spark, d):
    return C.valid_time_filter(incident_source(spark, d)).select("folio", "hora_creacion")


@register("clean_month", with_clean(
    f"SELECT * FROM clean WHERE ano = {MONTH_YEAR} AND mes = {MONTH_NUM}"))
def q_clean_month(spark, d):
    return C.clean_month(parsed_incidents(spark, d), MONTH_YEAR, MONTH_NUM)


@register("guarded_drop", with_proc("""
SELECT p.folio, p.delegacion_inicio FROM proc p,
  (SELECT count(*) FILTER (WHERE delegacion_inicio = 'na')::double / nullif(count(*), 0) AS share
   FROM proc) s
WHERE p.delegacion_inicio IS NULL OR p.delegacion_inicio <> 'na' OR s.share IS NULL OR s.share >= 0.03"""))
def q_guarded_drop(spark, d):
    return C.guarded_drop(processed_table(spark, d)).select("folio", "delegacion_inicio")


@register("standardize_names", """
SELECT c_custkey AS "c_custkey", c_name AS "nombre_cliente", c_mktsegment AS "segmento_de_mercado",
       c_acctbal AS "ano_saldo" FROM customer""")
def q_standardize_names(spark, d):
    # Raw headers as a source might deliver them (spaces, capitals, ñ).
    raw = table(spark, d, "customer").select(
        F.col("c_custkey").alias("C_CUSTKEY"), F.col("c_name").alias("Nombre Cliente"),
        F.col("c_mktsegment").alias("Segmento De Mercado"), F.col("c_acctbal").alias("Año Saldo"))
    return raw.toDF(*[standardize_name(c) for c in raw.columns])


@register("split_column", """
SELECT o_orderkey, split_part(o_orderpriority, '-', 1) AS prioridad_num,
       CASE WHEN strpos(o_orderpriority, '-') > 0
            THEN substr(o_orderpriority, strpos(o_orderpriority, '-') + 1) END AS prioridad_texto
FROM orders""")
def q_split_column(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return (C.split_column(orders, "o_orderpriority", "prioridad_num", "prioridad_texto", "-")
            .drop("o_orderpriority"))


@register("drop_columns", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def q_drop_columns(spark, d):
    orders = table(spark, d, "orders")
    return C.drop_columns(orders, "o_totalprice", "o_orderdate", "o_orderpriority")


@register("json_extract_events", """
SELECT event_id, event_type, json_extract_string(props, '$.k') AS k,
       CAST(json_extract_string(props, '$.ausente') AS varchar) AS ausente,
       cast(hour(ts) AS integer) AS hora FROM events""")
def q_json_extract_events(spark, d):
    ev = table(spark, d, "events", spread=True).select("event_id", "event_type", "ts", "props")
    out = C.json_extract(ev, ["k", "ausente"], col="props", keep=["event_id", "event_type", "ts"])
    return out.select("event_id", "event_type", "k", "ausente", F.hour("ts").alias("hora"))


# Every so many records is spoilt in one way (fixed values; the key decides).
SPOILT = {"json": 101, "mes": 103, "latitud": 107}


def _spoilt_documents(spark, d):
    """Raw records of which some are broken, some hold a word for a month or a
    latitude, and some (as in all tables) have no valid time."""
    src = incident_source(spark, d).withColumn("llamada", F.col("folio").cast("bigint"))
    hit = {k: F.col("llamada") % n == 0 for k, n in SPOILT.items()}
    fields = [F.when(hit[c], F.lit("abc")).otherwise(F.col(c).cast("string")).alias(c) if c in hit else F.col(c)
              for c in src.columns if c != "llamada"]
    doc = F.to_json(F.struct(*fields))
    broken = F.substring(doc, 1, 40)                       # ends within the document
    return src.select("llamada", F.when(hit["json"], broken).otherwise(doc).alias("registros"))


_ERRORS_SQL = "list_filter([" + ", ".join(
    f"CASE WHEN folio::bigint % {SPOILT[c]} = 0 THEN '{c}' END" for c in ("mes", "latitud")) + \
    ", CASE WHEN NOT contains(hora_creacion, ':') THEN 'hora_creacion' END], lambda e: e IS NOT NULL)"


@register("quarantine", with_inc(f"""
SELECT folio::bigint AS llamada, array_to_string(CASE WHEN folio::bigint % {SPOILT['json']} = 0 THEN ['json'] ELSE {_ERRORS_SQL} END, ',') AS errores
FROM inc"""))
def q_quarantine(spark, d):
    """Where each record went: nothing for the clean table's, its errors for the
    rejected; together they are all records."""
    clean, rejected = clean_or_reject(_spoilt_documents(spark, d), keep=["llamada"])
    return clean.select("llamada", F.lit("").alias("errores")).unionByName(
        rejected.select("llamada", F.array_join("errores", ",").alias("errores")))


@register("quarantine_clean", with_clean(f"SELECT * FROM clean WHERE " + " AND ".join(
    f"folio::bigint % {n} <> 0" for n in SPOILT.values())))
def q_quarantine_clean(spark, d):
    """The clean table of records some of which are spoilt."""
    return clean_or_reject(_spoilt_documents(spark, d))[0]
