"""Exact order statistics of a column by repeated histograms.

A pass maps every value to one of ``CELLS`` cells by a function that never
decreases, counts the cells (combined on the map side) and keeps the cell that
holds the wanted rank; the next pass cuts only that cell's span. A cell whose
least and largest value agree is the answer. No task ever holds or sorts the
values: a pass moves at most ``CELLS`` rows a wanted rank, whatever the column, and a dense
column of 64-bit floats takes a handful of passes, which all wanted ranks share.

Within a span the cells are of equal width; where the span reaches over many
powers of two they are of equal ratio, so that tiny and huge values in one
column do not cost a pass each.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELLS, WIDE = 4096, 4096.0


@dataclass
class Span:
    """Values from ``low`` to ``high``, both ends counted; the ``n`` values below ``low``."""

    low: float
    high: float
    below: int


def cell_of(value: Column, low: float, high: float, cells: int) -> Column:
    """The number of a value's cell between two values; it never falls as the value grows."""
    if low < 0 <= high:
        return (value >= 0).cast("int")
    if min(abs(low), abs(high)) > 0 and max(low / high, high / low) > WIDE:
        a, b = sorted((math.log(abs(low)), math.log(abs(high))))
        part = (F.log(F.abs(value)) - F.lit(a)) / F.lit(max(b - a, 5e-324))
        part = part if low > 0 else F.lit(1.0) - part
    elif math.isinf(high - low):
        part = value / F.lit(high) - F.lit(low / high)  # the width itself would not be a number
    else:
        part = (value - F.lit(low)) / F.lit(high - low)
    return F.least(F.lit(cells - 1), F.greatest(F.lit(0), F.floor(part * cells))).cast("int")


@dataclass
class Values:
    """A column's values as doubles and how many there are of each kind."""

    inner: DataFrame
    whole: object

    @classmethod
    def of(cls, df: DataFrame, column: str) -> Values:
        known = df.select(F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull())
        proper = ~F.isnan("v") & (F.abs("v") != float("inf"))
        whole = known.agg(F.count_if(F.isnan("v")).alias("nan"), F.count(F.lit(1)).alias("n"), F.count_if(F.col("v") == float("-inf")).alias("least"),
                          F.count_if(F.col("v") == float("inf")).alias("most"), F.min(F.when(proper, F.col("v"))).alias("low"),
                          F.max(F.when(proper, F.col("v"))).alias("high")).first()
        return cls(known.where(proper), whole)

    def ranks(self, ranks: list[int], cells: int) -> list[float | None]:
        whole, n = self.whole, self.whole.n - self.whole.nan
        out: dict[int, float | None] = {}
        for rank in sorted(set(ranks)):
            if not 0 <= rank < whole.n:
                out[rank] = None
            elif rank >= n:
                out[rank] = math.nan
            elif rank < whole.least:
                out[rank] = -math.inf
            elif rank >= n - whole.most:
                out[rank] = math.inf
        open_ = [r for r in sorted(set(ranks)) if r not in out]
        todo = [(Span(whole.low, whole.high, whole.least), open_)] if open_ else []
        while todo:  # ranks that fall into one span share its cells, all spans share a pass
            for span, wanted in todo:
                if span.low == span.high:
                    out.update((r, span.low) for r in wanted)
            todo = [(span, wanted) for span, wanted in todo if span.low != span.high]
            found = self._cells([span for span, _ in todo], cells) if todo else []
            todo = [(Span(r.low, r.high, below), inside)
                    for (span, wanted), rows in zip(todo, found)
                    for r, below in _counted(rows, span.below)
                    if (inside := [x for x in wanted if below <= x < below + r.n])]
        return [out[r] for r in ranks]

    def _cells(self, spans: list[Span], cells: int) -> list[list]:
        """For each span its cells in order, from one pass (spans do not overlap)."""
        which = cell = F.lit(None).cast("int")
        for i, span in enumerate(spans):
            here = (F.col("v") >= span.low) & (F.col("v") <= span.high)
            which = F.when(here, F.lit(i)).otherwise(which)
            cell = F.when(here, cell_of(F.col("v"), span.low, span.high, cells)).otherwise(cell)
        rows = (self.inner.select("v", which.alias("span"), cell.alias("cell")).where(F.col("span").isNotNull()).groupBy("span", "cell")
                .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect())
        return [sorted((r for r in rows if r.span == i), key=lambda r: r.cell) for i in range(len(spans))]


def _counted(rows: list, below: int):
    """Each cell with the number of values before it."""
    for r in rows:
        yield r, below
        below += r.n


def select_ranks(df: DataFrame, column: str, ranks: list[int], cells: int = CELLS) -> list[float | None]:
    """The values at the ranks (from 0) of the sorted column; nulls are left out,
    NaN counts as the largest value. A rank that there is not gives None."""
    if cells < 2:
        raise ValueError("a pass needs two cells at least")
    return Values.of(df, column).ranks(ranks, cells)


def percentiles_exact(df: DataFrame, column: str, shares: Sequence[float], cells: int = CELLS) -> list[float | None]:
    """The continuous percentiles of the column (two neighbouring values in
    proportion), the same numbers as ``percentile`` gives; None without values.
    All of them come from the same passes."""
    values = Values.of(df, column)
    if not values.whole.n:
        return [None for _ in shares]
    at = [(values.whole.n - 1) * share for share in shares]
    found = values.ranks([r for x in at for r in (math.floor(x), math.ceil(x))], cells)
    out = []
    for x, a, b in zip(at, found[::2], found[1::2]):
        low, high = math.floor(x), math.ceil(x)
        out.append(a if low == high or a == b else (high - x) * a + (x - low) * b)
    return out


def percentile_exact(df: DataFrame, column: str, share: float, cells: int = CELLS) -> float | None:
    """One of ``percentiles_exact``."""
    return percentiles_exact(df, column, [share], cells)[0]
