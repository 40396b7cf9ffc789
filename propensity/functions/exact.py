"""Order-independent means.

Floating-point sums depend on the order rows are added, i.e. on partitioning.
Where every value is exactly a decimal of up to ten places (money amounts),
the sum is taken over DECIMAL and is the same for every layout and engine;
other values take the plain double average.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SUM_DECIMAL = "decimal(38,10)"


def exact_mean(c) -> Column:
    """mean() of a double column; NULL and NaN are skipped in sum and count."""
    c = c if isinstance(c, Column) else F.col(c)
    x = F.when(~F.isnan(c.cast("double")), c.cast("double"))
    d = x.try_cast(SUM_DECIMAL)
    whole = F.coalesce(F.bool_and(F.when(x.isNotNull(), F.coalesce(
        d.cast("double") == x, F.lit(False)))), F.lit(False))
    return F.when(whole, F.sum(d).cast("double") / F.count(x)).otherwise(F.avg(x))
