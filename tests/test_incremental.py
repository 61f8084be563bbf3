import json

from vigil.session import shared_dir
from vigil.sources import files as S
from vigil.streaming.incremental import read_clean, run_incremental_clean, run_scoring


def test_late_records_and_null_months_replace_nothing(spark):
    raw, out, ckpt = (shared_dir(spark, n) for n in ("raw-inc", "clean-inc", "ckpt-inc"))

    def deliver(rows, mode="append"):
        """(folio, own year, own month, folder's year, folder's month)"""
        docs = [(json.dumps({"folio": f, "hora_creacion": "10:00:00", "ano": a, "mes": m}), y, k) for f, a, m, y, k in rows]
        S.write_raw(spark.createDataFrame(docs, "registros string, year int, month int"), raw, mode)
        run_incremental_clean(spark, raw, out, ckpt)
        return sorted((r.folio, r.ano, r.mes) for r in read_clean(spark, out).collect())

    first = [("a", "2020", "1", 2020, 1), ("b", "2020", "1", 2020, 1), ("c", "2020", "2", 2020, 2),
             ("d", None, None, 2020, 2), ("e", "2020", "2", None, None), ("f", "2020", "2", 2020, None)]
    own = lambda rows: sorted((f, a and int(a), m and int(m)) for f, a, m, *_ in rows)
    got = lambda rows: sorted(rows, key=str)
    assert got(deliver(first)) == got(own(first))
    late = [("g", "2020", "3", 2020, 3), ("h", "2020", "1", 2020, 3), ("i", None, None, 2020, 3), ("j", "2020", "3", None, None)]
    assert got(deliver(late)) == got(own(first + late))
    again = [("a", "2020", "1", 2020, 1), ("k", "2020", "2", 2020, 1)]
    assert got(deliver(again, "overwrite")) == got(own([r for r in first + late if r[0] not in "ab"] + again))
    # a month delivered again without a valid record has no rows left, null ones alike
    raw_rows = [(json.dumps({"folio": "z", "hora_creacion": "10"}), y, k) for y, k in ((2020, 1), (None, None))]
    S.write_raw(spark.createDataFrame(raw_rows, "registros string, year int, month int"), raw, "overwrite")
    run_incremental_clean(spark, raw, out, ckpt)
    kept = {r.folio for r in read_clean(spark, out).collect()}
    assert kept == {"c", "d", "f", "g", "h", "i"}


def test_predictions_follow_the_clean_table(spark):
    raw, clean, changes, out, a, b = (shared_dir(spark, n) for n in ("raw-s", "clean-s", "changes-s", "pred-s", "ckpt-a", "ckpt-b"))
    scored = []

    def score(rows):
        scored.append(sorted({(r.year, r.month) for r in rows.select("year", "month").collect()}, key=str))
        return rows.selectExpr("folio", "length(folio) AS y", "year", "month")

    def deliver(rows, mode="append"):
        docs = [(json.dumps({"folio": f, "hora_creacion": t}), y, k) for f, t, y, k in rows]
        S.write_raw(spark.createDataFrame(docs, "registros string, year int, month int"), raw, mode)
        run_incremental_clean(spark, raw, clean, a, changes)
        run_scoring(spark, changes, clean, out, b, score)
        return sorted((r.folio, r.y) for r in spark.read.schema("folio string, y int").parquet(out).collect())

    assert deliver([("a", "1:00", 2020, 1), ("bb", "1:00", 2020, 1), ("c", "1:00", 2020, 2), ("d", "1:00", None, None)]) == \
        [("a", 1), ("bb", 1 + 1), ("c", 1), ("d", 1)]
    assert deliver([("eee", "1:00", 2020, 1)], "overwrite") == [("c", 1), ("d", 1), ("eee", 3)]
    assert scored[-1] == [(2020, 1)]                       # only the month that changed
    assert deliver([("x", "no time", None, None), ("y", "no time", 2020, 2)], "overwrite") == [("eee", 3)]
    before = len(scored)
    run_incremental_clean(spark, raw, clean, a, changes)
    run_scoring(spark, changes, clean, out, b, score)
    assert len(scored) == before                           # nothing new, nothing scored
