"""SQL twins of the shared frames, as CTE text for the DuckDB oracles."""

from __future__ import annotations

from vigil.functions.text import sql_remove_points as rp
from vigil.functions.text import sql_unaccent as ua
from vigil.operators.features import sql_digest_bucket
from vigil.plans.incidents import INCIDENT_SQL

CLEAN_SELECT = f"""
SELECT folio, hora_creacion,
       {rp('lower(delegacion_inicio)')} AS delegacion_inicio,
       {ua('lower(dia_semana)')} AS dia_semana,
       {ua('lower(tipo_entrada)')} AS tipo_entrada,
       cast(mes AS smallint) AS mes,
       cast(latitud AS double) AS latitud,
       cast(longitud AS double) AS longitud,
       cast(ano AS integer) AS ano,
       {ua(rp('lower(incidente_c4)'))} AS incidente_c4,
       {ua(rp('lower(codigo_cierre)'))} AS codigo_cierre
FROM inc WHERE contains(hora_creacion, ':')
"""

PROC_SELECT = """
SELECT *, split_part(incidente_c4, '-', 1) AS incidente_c4_rec,
       try_cast(split_part(hora_creacion, ':', 1) AS integer) AS hora,
       substr(codigo_cierre, 2, 1) AS clave,
       CASE WHEN substr(codigo_cierre, 2, 1) = 'a' THEN 1 ELSE 0 END AS target
FROM clean
"""

MODEL_SELECT = """
SELECT p.* FROM proc p,
  (SELECT count(*) FILTER (WHERE delegacion_inicio = 'na')::double / nullif(count(*), 0) AS share
   FROM proc) s
WHERE p.delegacion_inicio IS NULL OR p.delegacion_inicio <> 'na' OR s.share IS NULL OR s.share >= 0.03
"""


def with_inc(body: str) -> str:
    return f"WITH inc AS ({INCIDENT_SQL})\n{body}"


def with_clean(body: str) -> str:
    return f"WITH inc AS ({INCIDENT_SQL}), clean AS ({CLEAN_SELECT})\n{body}"


def with_proc(body: str) -> str:
    return (f"WITH inc AS ({INCIDENT_SQL}), clean AS ({CLEAN_SELECT}), proc AS ({PROC_SELECT})\n"
            f"{body}")


def with_model(body: str) -> str:
    return (f"WITH inc AS ({INCIDENT_SQL}), clean AS ({CLEAN_SELECT}), proc AS ({PROC_SELECT}),"
            f" model AS ({MODEL_SELECT})\n{body}")

SPLIT_SELECT = f"""
SELECT m.*, CASE WHEN make_date(m.ano, m.mes, 1) = n.newest THEN 'nuevo'
                 WHEN make_date(m.ano, m.mes, 1) > n.newest THEN 'posterior'
                 WHEN {sql_digest_bucket('m.folio', 100, 'split0')} < 70 THEN 'train' ELSE 'test' END AS conjunto
FROM model m, (SELECT cast(date_trunc('month', max(o_orderdate)) - INTERVAL 1 MONTH AS date) AS newest FROM orders) n
"""

MODA_SELECT = """
SELECT delegacion_inicio AS moda FROM split WHERE conjunto = 'train' AND delegacion_inicio IS NOT NULL
GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1
"""

SCORED_SELECT = """
SELECT s.* REPLACE (cast(s.mes AS integer) AS mes,
                   coalesce(s.delegacion_inicio, (SELECT moda FROM moda)) AS delegacion_inicio),
       1 - coalesce(r.rate, g.global_rate) AS y_proba_0,
       coalesce(r.rate, g.global_rate) AS y_proba_1,
       CASE WHEN coalesce(r.rate, g.global_rate) >= 0.5 THEN 1 ELSE 0 END AS y_etiqueta
FROM split s
LEFT JOIN (SELECT tipo_entrada, incidente_c4_rec, hora, avg(cast(target AS double)) AS rate
           FROM split WHERE conjunto = 'train' GROUP BY ALL) r
  ON s.tipo_entrada = r.tipo_entrada AND s.incidente_c4_rec = r.incidente_c4_rec AND s.hora = r.hora
CROSS JOIN (SELECT avg(cast(target AS double)) AS global_rate FROM split WHERE conjunto = 'train') g
"""

PRED_COLS = ("folio, mes, hora, delegacion_inicio, dia_semana, tipo_entrada, incidente_c4_rec, "
             "ano, y_proba_0, y_proba_1, y_etiqueta")


def with_scored(body: str) -> str:
    return (f"WITH inc AS ({INCIDENT_SQL}), clean AS ({CLEAN_SELECT}), proc AS ({PROC_SELECT}),"
            f" model AS ({MODEL_SELECT}), split AS ({SPLIT_SELECT}), moda AS ({MODA_SELECT}), scored AS ({SCORED_SELECT}),"
            f" hist AS (SELECT {PRED_COLS}, target AS y_test FROM scored WHERE conjunto = 'test'),"
            f" live AS (SELECT {PRED_COLS}, target AS y_test FROM scored WHERE conjunto = 'nuevo')\n"
            f"{body}")
