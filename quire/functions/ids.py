"""Preprint id -> canonical URL and year (X11).

An id containing ``.`` is new-style ``yymm.nnnnn``: year = ``20`` + the first
two characters before the dot. Otherwise it is old-style ``yymmnnn`` under a
fixed subject path: two-digit years above 07 are 19yy, the rest 20yy (so
1900-1907 map to 2000-2007, as in the reference). A non-numeric old-style
prefix gives a null year (the record becomes an ``error`` reject).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the id scheme.
OLD_ID_PATH = "cs/"
OLD_CENTURY_PIVOT = 7
DEFAULT_BASE = "https://preprints.example.org/abs/"


def preprint_url_and_year(pid: Column, base: str = DEFAULT_BASE) -> Column:
    new = F.contains(pid, F.lit("."))
    yy_new = F.substring(F.substring_index(pid, ".", 1), 1, 2)
    yy_old = F.substring(pid, 1, 2)
    yy_num = yy_old.try_cast("int")
    year = F.when(new, F.concat(F.lit("20"), yy_new)).otherwise(
        F.when(yy_num > OLD_CENTURY_PIVOT, F.concat(F.lit("19"), yy_old))
        .when(yy_num.isNotNull(), F.concat(F.lit("20"), yy_old)))
    url = F.when(new, F.concat(F.lit(base), pid)).otherwise(F.concat(F.lit(base + OLD_ID_PATH), pid))
    return F.struct(url.alias("url"), year.alias("year"))
