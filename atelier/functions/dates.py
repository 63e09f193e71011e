"""Date expressions (F1, F2).

``month_key`` renders the reporting period. The reference writes
``TO_CHAR(d, 'yyyy-mm')``, where ``mm`` is the month; in Spark's pattern
language ``mm`` is minutes, so the pattern here is ``yyyy-MM``.

``day_diff`` is ``completion - created`` in whole days. Spark's ``date - date``
yields an interval, so ``datediff`` is used; it is NULL while an order has no
completion date, which keeps such orders out of the median.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: output format of the reporting period, e.g. 2024-03.
MONTH_PATTERN = "yyyy-MM"


def month_key(created: Column | str) -> Column:
    return F.date_format(F.col(created) if isinstance(created, str) else created, MONTH_PATTERN)


def day_diff(end: Column | str, start: Column | str) -> Column:
    end_c = F.col(end) if isinstance(end, str) else end
    start_c = F.col(start) if isinstance(start, str) else start
    return F.datediff(end_c, start_c)
