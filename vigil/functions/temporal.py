"""Calendar expressions: month spines and the extract cut-off month."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_list(start, end) -> Column:
    """Array of month starts from ``start`` to ``end``, both ends included."""
    return F.sequence(F.trunc(_col(start), "MM"), F.trunc(_col(end), "MM"),
                      F.expr("interval 1 month"))


def closed_month(run_date) -> Column:
    """Last month whose data is complete on ``run_date``.

    After the 15th it is the previous month, otherwise the month before that.
    ``add_months`` carries over year ends, so January and February work.
    """
    d = _col(run_date)
    return F.trunc(F.add_months(d, F.when(F.dayofmonth(d) > 15, -1).otherwise(-2)), "MM")


def format_run_time(ts) -> Column:
    """Lineage time text ``dd/MM/yyyy HH:mm:ss``."""
    return F.date_format(_col(ts), "dd/MM/yyyy HH:mm:ss")
