"""Query keys: sources and sinks (S1-S14). Written tables go to fresh
folders under the cluster's shared checkpoint root."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil.catalog import MODEL_INPUT, RAW_FIELDS, table
from vigil.operators.clean import parse_documents
from vigil.plans.frames import clean_table, historic_predictions, incident_source, processed_table
from vigil.plans.registry import register
from vigil.plans.sql import with_clean, with_inc, with_proc, with_scored
from vigil.session import shared_dir
from vigil.sources import files as S

MONTH = (1996, 4)
PAGE_SIZE = 10_000  # records per page of the source API
INC_FIELDS = ("folio, hora_creacion, delegacion_inicio, dia_semana, tipo_entrada, mes, ano, "
              "incidente_c4, codigo_cierre, latitud, longitud")
_FIELD_NAMES = [c.strip() for c in INC_FIELDS.split(",")]
_FIELDS_SCHEMA = RAW_FIELDS


def _landing(spark, d):
    path = shared_dir(spark, "landing")
    S.land_api_records(incident_source(spark, d), path)
    return path


def _ingest(spark, d, year=None, month=None):
    landing = _landing(spark, d)
    raw_path = shared_dir(spark, "raw")
    S.write_raw(S.to_raw(S.read_api_records(spark, landing, _FIELDS_SCHEMA, year, month)), raw_path)
    return raw_path


@register("ingest_month", with_inc(
    f"SELECT {INC_FIELDS} FROM inc WHERE ano = '{MONTH[0]}' AND mes = '{MONTH[1]}'"))
def q_ingest_month(spark, d):
    raw_path = _ingest(spark, d, *MONTH)
    return parse_documents(S.read_raw(spark, raw_path, *MONTH)).select(*_FIELD_NAMES)


@register("ingest_all", with_inc(f"SELECT {INC_FIELDS} FROM inc"))
def q_ingest_all(spark, d):
    raw_path = _ingest(spark, d)
    return parse_documents(S.read_raw(spark, raw_path)).select(*_FIELD_NAMES)


@register("raw_append", with_inc("""
SELECT cast(ano AS integer) AS year, cast(mes AS integer) AS month, count(*) AS n FROM inc GROUP BY 1, 2"""))
def q_raw_append(spark, d):
    landing = _landing(spark, d)
    raw_path = shared_dir(spark, "raw")
    recs = S.to_raw(S.read_api_records(spark, landing, _FIELDS_SCHEMA))
    S.write_raw(recs.filter(F.col("year") < 1998), raw_path, "append")
    S.write_raw(recs.filter(F.col("year") >= 1998), raw_path, "append")
    # a re-delivered month replaces its own partition only (idempotent)
    S.write_raw(recs.filter((F.col("year") == 1998) & (F.col("month") == 1)), raw_path, "overwrite")
    return S.read_raw(spark, raw_path).groupBy("year", "month").agg(F.count(F.lit(1)).alias("n"))


@register("partition_prune", with_inc("""
SELECT cast(mes AS integer) AS month, count(*) AS n FROM inc WHERE ano = '2000' GROUP BY 1"""))
def q_partition_prune(spark, d):
    raw_path = _ingest(spark, d)
    return S.read_raw(spark, raw_path, year=2000).groupBy("month").agg(F.count(F.lit(1)).alias("n"))


@register("scan_table", with_clean("SELECT * FROM clean"))
def q_scan_table(spark, d):
    path = shared_dir(spark, "clean")
    clean_table(spark, d).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@register("tsv_roundtrip", with_proc(f"SELECT folio, {', '.join(MODEL_INPUT)} FROM proc"))
def q_tsv_roundtrip(spark, d):
    df = processed_table(spark, d).select("folio", *MODEL_INPUT)
    path = shared_dir(spark, "tsv")
    S.write_tsv(df, path, header=True)
    return S.read_tsv(spark, path, df.schema, header=True)


@register("tsv_headerless", with_scored("SELECT * FROM hist"))
def q_tsv_headerless(spark, d):
    df = historic_predictions(spark, d)
    path = shared_dir(spark, "tsv")
    S.write_tsv(df, path, header=False)
    return S.read_tsv(spark, path, df.schema, header=False)


@register("page_chunks", f"""
SELECT *, cast((row_number() OVER (ORDER BY o_orderkey) - 1) // {PAGE_SIZE} AS integer) AS pagina
FROM orders""")
def q_page_chunks(spark, d):
    return S.add_page_numbers(table(spark, d, "orders"), "o_orderkey", PAGE_SIZE)


@register("json_flatten", with_inc("SELECT folio AS recordid, " + ", ".join(
    f"{c} AS fields_{c}" for c in _FIELD_NAMES) + ", cast(ano AS integer) AS YEAR, "
    "cast(mes AS integer) AS MONTH FROM inc"))
def q_json_flatten(spark, d):
    landing = _landing(spark, d)
    flat = S.flatten_structs(S.read_api_records(spark, landing, _FIELDS_SCHEMA))
    return flat.drop("fields_geopoint")


@register("array_pick", with_inc("SELECT folio, latitud, longitud FROM inc"))
def q_array_pick(spark, d):
    src = incident_source(spark, d)
    return src.select("folio", F.get(F.col("geopoint"), 0).cast("double").alias("latitud"),
                      F.get(F.col("geopoint"), 1).cast("double").alias("longitud"))


@register("incremental_clean", with_clean("SELECT * FROM clean"))
def q_incremental_clean(spark, d):
    from vigil.streaming.incremental import read_clean, run_incremental_clean
    landing = _landing(spark, d)
    raw_path, out, ckpt = shared_dir(spark, "raw"), shared_dir(spark, "clean"), shared_dir(spark, "ckpt")
    recs = S.to_raw(S.read_api_records(spark, landing, _FIELDS_SCHEMA))
    # two deliveries: the months before 2000, then the rest; each run of the
    # stream picks up only the files it has not committed yet
    S.write_raw(recs.filter(F.col("year") < 2000), raw_path, "append")
    run_incremental_clean(spark, raw_path, out, ckpt)
    S.write_raw(recs.filter(F.col("year") >= 2000), raw_path, "append")
    run_incremental_clean(spark, raw_path, out, ckpt)
    run_incremental_clean(spark, raw_path, out, ckpt)  # nothing new: no duplicate rows
    return read_clean(spark, out)
