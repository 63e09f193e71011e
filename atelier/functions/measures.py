"""Expressions behind the mart measures.

Money stays integral or decimal end to end, so results never depend on the
order in which partial sums are combined.

- The platform fee is 10 % of the spend, stored in an INT column. The
  reference assigns a numeric to INT, which rounds half away from zero; a
  plain Spark cast truncates, so the value is rounded first (``F.round`` is
  HALF_UP on decimals).
- The average price is stored as DECIMAL(10,2). It is computed exactly in
  integer cents from (sum, count): ``round_half_up(cents / count)``. A
  decimal ``avg`` carries only scale + 4 digits and would round twice.
- Status flags follow SQL three-valued logic: a NULL status counts in the
  total only, in neither ``= 'done'`` nor ``!= 'done'``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the platform's share of the customer's spend.
PLATFORM_FEE_RATE = Decimal("0.1")


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def fee_rounded(spend: Column | str, rate: Decimal = PLATFORM_FEE_RATE) -> Column:
    """round_half_up(spend * rate) as an exact decimal with scale 0."""
    return F.round(_c(spend).cast("decimal(30,2)") * F.lit(rate), 0)


def avg_cents(total: Column | str, count: Column | str) -> Column:
    """Average in cents, rounded half away from zero, with integer arithmetic.

    With s the total in cents, floor((2*|s| + c) / (2c)) == round_half_up(|s|/c)
    for c > 0. The floor is taken exactly: the numerator minus its remainder is
    a multiple of the divisor, so the division has an integral result.
    """
    s = (_c(total).cast("decimal(30,2)") * 100).cast("long")
    c = _c(count).cast("long")
    num = F.abs(s) * F.lit(2) + c
    den = c * F.lit(2)
    quotient = ((num - F.pmod(num, den)) / den).cast("long")
    return F.when(c > 0, F.signum(s).cast("long") * quotient)


def cents_to_double(cents: Column | str) -> Column:
    return _c(cents).cast("double") / F.lit(100.0)
