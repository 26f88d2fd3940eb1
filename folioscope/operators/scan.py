"""Scans over ordered rows in two levels, so that no group's length decides how much one task gets.

The rows of a group are cut into ranges of their order. Each range is scanned by itself; what a range hands to the next (its last value, its sum, its
first and last rows) is a row of a small table, which is scanned in turn; then both are put together. A task gets `size` rows of a group at most,
or a row for each range of it.

`order` is a number that tells the rows of a group apart, such as a line's place; gaps only make ranges smaller. Null groups are a group. Rows of a null
order come first, in one range.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a group that one task scans at most, where the order has no repeats.
SIZE = 100_000


@dataclass(frozen=True)
class Ahead:
    """The last (or first) value that isn't null from a row to `reach` rows on."""

    value: Column
    reach: int = 20
    last: bool = True


def scan(rows: DataFrame, by: str, order: str, last: Mapping[str, Column] | None = None, total: Mapping[str, Column] | None = None, before: Mapping[str, Column] | None = None, after: Mapping[str, Column] | None = None, ahead: Mapping[str, Ahead] | None = None, size: int = SIZE) -> DataFrame:
    """Adds columns: `last` value that isn't null up to and with a row, running `total`, the value of the row `before` and `after`, and what is `ahead`."""
    last, total, before, after, ahead = (dict(x or {}) for x in (last, total, before, after, ahead))
    columns = rows.columns
    given = {**{f"_in_{n}": c for x in (last, total, before, after) for n, c in x.items()}, **{f"_in_{n}": a.value for n, a in ahead.items()}}
    cut = rows.withColumns(given).withColumn("_range", F.coalesce(F.floor(F.col(order) / size), F.lit(-(1 << 62))))
    w = Window.partitionBy(by, "_range").orderBy(F.col(order).asc_nulls_first())
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    own = {f"_own_{n}": F.last(f"_in_{n}", True).over(upto) for n in last}
    own |= {f"_own_{n}": F.sum(f"_in_{n}").over(upto) for n in total}
    own |= {f"_own_{n}": F.lag(f"_in_{n}").over(w) for n in before}
    own |= {f"_own_{n}": F.lead(f"_in_{n}").over(w) for n in after}
    own |= {f"_own_{n}": (F.last if a.last else F.first)(f"_in_{n}", True).over(w.rowsBetween(0, a.reach)) for n, a in ahead.items()}
    own |= {"_place": F.row_number().over(w), "_rows": F.count(F.lit(1)).over(Window.partitionBy(by, "_range"))}
    local = cut.withColumns(own)

    # one row a range: what it hands on
    states = [F.last(F.lit(True)).alias("_any")]
    states += [F.max_by(f"_in_{n}", F.when(F.col(f"_in_{n}").isNotNull(), F.col("_place"))).alias(f"_at_{n}") for n in last]
    states += [F.sum(f"_in_{n}").alias(f"_at_{n}") for n in total]
    states += [F.max_by(F.struct(F.col(f"_in_{n}").alias("v")), "_place").alias(f"_at_{n}") for n in before]
    states += [F.min_by(F.struct(F.col(f"_in_{n}").alias("v")), "_place").alias(f"_at_{n}") for n in after]
    head = lambda n, a: F.array_sort(F.collect_list(F.when(F.col("_place") <= a.reach, F.struct("_place", F.col(f"_in_{n}").alias("v")))))
    states += [head(n, a).alias(f"_at_{n}") for n, a in ahead.items()]
    ranges = local.groupBy(by, "_range").agg(*states)
    r = Window.partitionBy(by).orderBy("_range")
    earlier = r.rowsBetween(Window.unboundedPreceding, -1)
    handed = {n: F.last(f"_at_{n}", True).over(earlier) for n in last}
    handed |= {n: F.sum(f"_at_{n}").over(earlier) for n in total}
    handed |= {n: F.lag(f"_at_{n}").over(r)["v"] for n in before}
    handed |= {n: F.lead(f"_at_{n}").over(r)["v"] for n in after}
    # a range has a row at least, so as many ranges as rows are enough
    handed |= {n: F.slice(F.flatten(F.collect_list(f"_at_{n}").over(r.rowsBetween(1, a.reach))), 1, a.reach) for n, a in ahead.items()}
    carried = ranges.select(F.col(by).alias("_by"), F.col("_range").alias("_of"), *(c.alias(f"_handed_{n}") for n, c in handed.items()))

    both = local.join(carried, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_range") == F.col("_of")), "left")
    found = {n: F.coalesce(f"_own_{n}", f"_handed_{n}") for n in last}
    found |= {n: F.when(F.col(f"_own_{n}").isNull(), F.col(f"_handed_{n}")).otherwise(F.col(f"_own_{n}") + F.coalesce(f"_handed_{n}", F.lit(0))) for n in total}
    found |= {n: F.when(F.col("_place") == 1, F.col(f"_handed_{n}")).otherwise(F.col(f"_own_{n}")) for n in before}
    found |= {n: F.when(F.col("_place") == F.col("_rows"), F.col(f"_handed_{n}")).otherwise(F.col(f"_own_{n}")) for n in after}
    for n, a in ahead.items():
        # of the rows beyond the range, those within reach
        beyond = F.slice(F.coalesce(f"_handed_{n}", F.array()), 1, F.greatest(F.lit(0), a.reach - (F.col("_rows") - F.col("_place"))).cast("int"))
        values = F.transform(F.filter(beyond, lambda x: x["v"].isNotNull()), lambda x: x["v"])
        found[n] = F.coalesce(F.try_element_at(values, F.lit(-1)), F.col(f"_own_{n}")) if a.last else F.coalesce(f"_own_{n}", F.try_element_at(values, F.lit(1)))
    return both.select(*columns, *(c.alias(n) for n, c in found.items()))
