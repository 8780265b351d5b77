"""Order-preserving bucket codes.

Medians, ranks and dense keys need rows in value order, but one sorted window over a whole table
would put the table into one task. These codes split an ordered column into two nested bucket
levels whose sizes are bounded by the number format, not by the data:

* ``b1``: at most about 4.3 million codes over the whole domain;
* ``b2``: at most about 2.1 million codes inside one ``b1``;
* at most 2**21 distinct values inside one ``b2``.

So an ordered step over the ``b1`` codes, over the ``b2`` codes of one ``b1``, or over the values
of one ``b2`` is always a bounded window, however large or skewed the table is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# 1/1477 in natural-log units is about 1/1024 of a doubling.
_LOG_STEPS = 1477.0
# Larger than the largest |floor(ln(x) * _LOG_STEPS)| a double can give.
_LOG_OFFSET = float(2**21)
_FINE_STEPS = float(2**31)


def bucket_levels(c: Column, dtype: T.DataType) -> tuple[Column, Column]:
    """Codes ``(b1, b2)`` of a number or date that never decrease when the value grows; 0 for null.

    Strings have no such codes: they are numbered by sampled ranges (``ordering.surrogate_key``).
    """
    if isinstance(dtype, T.StringType):
        raise TypeError("strings have no bucket codes of bounded size")
    if isinstance(dtype, T.DateType):
        c, dtype = F.unix_date(c), T.IntegerType()
    if isinstance(dtype, T.IntegralType):
        v = c.cast("long")
        return F.coalesce(F.shiftright(v, 42), F.lit(0)), F.coalesce(F.shiftright(v, 21), F.lit(0))
    v = c.cast("double")
    step = F.floor(F.ln(F.abs(v)) * _LOG_STEPS)
    coarse = F.signum(v) * (F.lit(_LOG_OFFSET) + step)
    fine = F.floor(v / F.exp(step / _LOG_STEPS) * _FINE_STEPS)
    zero = F.lit(0).cast("long")
    return F.coalesce(coarse.cast("long"), zero), F.coalesce(fine, zero)
