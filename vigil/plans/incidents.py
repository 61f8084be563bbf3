"""Incident-shaped records derived from the order tables.

orders x customer x nation play the role of emergency calls: the order key is
the call id, the nation the borough, the market segment the entry channel,
the order priority the incident type and the order status the closure code.
The derivation is a pure projection (no row is dropped); its SQL twin is
``INCIDENT_SQL`` for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.catalog import table

# --- fixed values: the mapping from order attributes to incident fields ------
WEEKDAYS = ("Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo")
INCIDENT_TYPES = {
    "1": "Accidente-Choque sin lesionados",
    "2": "Lesionado-Atropellado",
    "3": "Detención ciudadana-Atropellado",
    "4": "Cadáver-Accidente automovilístico",
}
INCIDENT_TYPE_OTHER = "Sismo-Persona atrapada"
CLOSURE_CODES = {
    "F": "(A) La unidad confirmó la emergencia.",
    "O": "(N) Nadie confirmó la emergencia.",
}
CLOSURE_CODE_OTHER = "(D) Reporte duplicado."
# -----------------------------------------------------------------------------


def incident_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw incident per order, all fields as text like the source API."""
    orders = table(spark, sf_dir, "orders", spread=True).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority", "o_totalprice")
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    # nation is a tiny dimension: the planner broadcasts it because its file
    # size is under spark.sql.autoBroadcastJoinThreshold (a checked size).
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # orders x customer is fact x large dimension: a shuffle join on the key,
    # re-planned by AQE (skew split for a hot customer).
    joined = (orders.join(customer, orders.o_custkey == customer.c_custkey)
              .join(nation, F.col("c_nationkey") == F.col("n_nationkey")))
    k = F.col("o_orderkey")
    weekday = F.element_at(F.array(*[F.lit(w) for w in WEEKDAYS]), (k % 7 + 1).cast("int"))
    prio = F.substring("o_orderpriority", 1, 1)
    incident = F.lit(INCIDENT_TYPE_OTHER)
    for key, label in reversed(list(INCIDENT_TYPES.items())):
        incident = F.when(prio == key, label).otherwise(incident)
    closure = F.lit(CLOSURE_CODE_OTHER)
    for key, label in reversed(list(CLOSURE_CODES.items())):
        closure = F.when(F.col("o_orderstatus") == key, label).otherwise(closure)
    lat = F.lit(19.0) + F.col("c_acctbal") / F.lit(100000.0)
    lon = F.lit(-99.0) - F.col("o_totalprice") / F.lit(10000000.0)
    return joined.select(
        k.cast("string").alias("folio"),
        F.concat(F.lpad((k % 24).cast("string"), 2, "0"),
                 F.when(k % 97 == 0, F.lit(".5")).otherwise(F.lit(":15:00"))).alias("hora_creacion"),
        F.when(F.col("o_custkey") % 50 == 0, F.lit("N/A"))
         .when(F.col("o_custkey") % 53 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("Á. "), F.col("n_name"))).alias("delegacion_inicio"),
        weekday.alias("dia_semana"),
        F.concat(F.lit("LLAMADA "), F.col("c_mktsegment")).alias("tipo_entrada"),
        F.month("o_orderdate").cast("string").alias("mes"),
        F.year("o_orderdate").cast("string").alias("ano"),
        incident.alias("incidente_c4"),
        closure.alias("codigo_cierre"),
        lat.alias("latitud"),
        lon.alias("longitud"),
        F.array(lat.cast("string"), lon.cast("string")).alias("geopoint"),
    )


def raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw record store: one JSON document per incident (``registros``)
    with integer partition columns ``year``/``month``."""
    src = incident_source(spark, sf_dir)
    return src.select(
        F.to_json(F.struct(*[F.col(c) for c in src.columns])).alias("registros"),
        F.col("ano").cast("int").alias("year"),
        F.col("mes").cast("int").alias("month"),
    )


# SQL twin for the DuckDB oracle (same projection as ``incident_source``).
INCIDENT_SQL = """
SELECT cast(o_orderkey AS varchar) AS folio,
       concat(lpad(cast(o_orderkey % 24 AS varchar), 2, '0'),
              CASE WHEN o_orderkey % 97 = 0 THEN '.5' ELSE ':15:00' END) AS hora_creacion,
       CASE WHEN o_custkey % 50 = 0 THEN 'N/A'
            WHEN o_custkey % 53 = 0 THEN NULL
            ELSE concat('Á. ', n_name) END AS delegacion_inicio,
       CASE o_orderkey % 7 WHEN 0 THEN 'Lunes' WHEN 1 THEN 'Martes' WHEN 2 THEN 'Miércoles'
            WHEN 3 THEN 'Jueves' WHEN 4 THEN 'Viernes' WHEN 5 THEN 'Sábado' ELSE 'Domingo' END AS dia_semana,
       concat('LLAMADA ', c_mktsegment) AS tipo_entrada,
       cast(extract(month FROM o_orderdate) AS varchar) AS mes,
       cast(extract(year FROM o_orderdate) AS varchar) AS ano,
       CASE substr(o_orderpriority, 1, 1)
            WHEN '1' THEN 'Accidente-Choque sin lesionados' WHEN '2' THEN 'Lesionado-Atropellado'
            WHEN '3' THEN 'Detención ciudadana-Atropellado' WHEN '4' THEN 'Cadáver-Accidente automovilístico'
            ELSE 'Sismo-Persona atrapada' END AS incidente_c4,
       CASE o_orderstatus WHEN 'F' THEN '(A) La unidad confirmó la emergencia.'
            WHEN 'O' THEN '(N) Nadie confirmó la emergencia.' ELSE '(D) Reporte duplicado.' END AS codigo_cierre,
       19.0 + c_acctbal / 100000.0 AS latitud,
       -99.0 - o_totalprice / 10000000.0 AS longitud
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""
