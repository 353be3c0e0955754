"""Exact order statistics that no single task has to sort alone.

Medians and rank sums need positions in a global order.  Numbers are cut into
digits that keep their order, a fixed function of the number: power of two
first, then twelve bits of the fraction after another.  Rows are counted per
digit before they are shuffled, so a step orders a few thousand counts at most,
and nothing is sampled or estimated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Values of one digit of the fraction, and the digits that tell all doubles apart.
RADIX = 4096
DIGITS = 6
#: Rows among which a median is looked up by value instead of by digit.
ROWS_IN_ORDER = 65_536
#: Distinct scores that one task orders at most, about.
SCORES_PER_SLICE = 500_000


def ordered_digit(value: Column, number: int) -> Column:
    """Digit ``number`` (from 1) of a double that is not NaN; comparing digits from
    the first on compares the doubles.

    The logarithm may round up just below a power of two.  It never falls as its
    argument grows, so order is kept; the fraction is then a little below 1.
    """
    size = F.abs(value)
    infinite = size == float("inf")
    exponent = F.floor(F.log2(size))
    if number == 1:
        digit = F.when(size == 0, 0).when(infinite, 3000).otherwise(exponent + 1100)
    else:
        shifted = F.floor(size / F.pow(F.lit(2.0), exponent) * float(RADIX ** (number - 1)))
        digit = F.when((size == 0) | infinite, 0).otherwise(shifted if number == 2 else shifted % RADIX)
    return F.when(value < 0, -digit).otherwise(digit).cast("bigint")


def exact_medians(df: DataFrame, columns, rows_in_order: int = ROWS_IN_ORDER) -> dict[str, float | None]:
    """Median of each column; the mean of the middle two for even counts.  NULL and
    NaN are left out; a column without a value has None.

    Each pass counts the rows of the interval that holds a middle value by their
    next digit and keeps the digit's own interval, at most ``DIGITS`` passes; of
    ``rows_in_order`` rows or fewer the value itself is looked up.  A column
    costs the driver two rows a pass.
    """
    columns = list(columns)
    middle: dict[str, list[float]] = {name: [] for name in columns}
    pending = [(name, None, None) for name in columns]
    ranks: list[list[int]] | None = None
    plain = [False] * len(pending)
    number = 1
    while pending:
        found = _narrowed(df, pending, ranks, plain, number).collect()  # at most two rows per interval
        wanted: dict[tuple, list[int]] = {}
        small: dict[tuple, bool] = {}
        for row in found:
            interval = (pending[row["interval"]][0], row["least"], row["greatest"])
            if row["least"] == row["greatest"]:
                middle[interval[0]].append(row["least"])
            else:
                wanted.setdefault(interval, []).append(row["rank"])
                small[interval] = row["n"] <= rows_in_order
        pending = list(wanted)
        ranks, plain = [wanted[each] for each in pending], [small[each] for each in pending]
        number += 1
    return {name: sum(values) / 2 if values else None for name, values in middle.items()}


def _narrowed(df: DataFrame, intervals: list[tuple], ranks: list[list[int]] | None, plain: list[bool], number: int) -> DataFrame:
    """(interval, rank, n, least, greatest): for each wanted rank of an interval the
    digit's (or value's) rows that hold it, and its rank among them."""
    parts = []
    for place, (name, least, greatest) in enumerate(intervals):
        value = F.col(name).cast("double")
        inside = F.lit(True) if least is None else value.between(least, greatest)
        step = value if plain[place] else ordered_digit(value, number).cast("double")
        value = F.when(inside & ~F.isnan(value), value)
        parts.append(F.struct(F.lit(place).alias("interval"), step.alias("step"), value.alias("value")))
    steps = (
        df.select(F.inline(F.array(*parts)))
        .where(F.col("value").isNotNull())
        .groupBy("interval", "step")
        .agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("least"), F.max("value").alias("greatest"))
    )
    order = Window.partitionBy("interval")
    before = F.coalesce(F.sum("n").over(order.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counted = steps.select("*", before.alias("before"), F.sum("n").over(order).alias("total"))
    if ranks is None:
        wanted = F.expr("array((total + 1) div 2, (total + 2) div 2)")
    else:
        each = F.array(*[F.array(*[F.lit(rank).cast("bigint") for rank in own]) for own in ranks])
        wanted = F.element_at(each, F.col("interval") + 1)
    picked = counted.select("*", F.explode(wanted).alias("rank")).where("rank > before and rank <= before + n")
    return picked.select("interval", (F.col("rank") - F.col("before")).alias("rank"), "n", "least", "greatest")


def most_frequent(df: DataFrame, columns) -> dict[str, str | None]:
    """Most frequent value per text column, the smallest one among equals."""
    pairs = F.array(*[F.struct(F.lit(name).alias("feature"), F.col(name).alias("value")) for name in columns])
    rows = (
        df.select(F.inline(pairs))
        .filter(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("feature")
        .agg(F.min(F.struct((-F.col("n")).alias("order"), "value"))["value"].alias("value"))
        .collect()  # one row per column
    )
    found = {row["feature"]: row["value"] for row in rows}
    return {name: found.get(name) for name in columns}


def rank_auc(scored: DataFrame, label: str, score: str, per_slice: int = SCORES_PER_SLICE) -> DataFrame:
    """One row ``roc_auc``: the chance that a positive outranks a negative,
    ties counting half; NULL when a class is missing.  Rows without a score (NULL
    or NaN) are left out.

    Equal scores collapse first.  Distinct scores fall into slices by their first
    digits, as many digits as it takes for no slice to hold more than ``per_slice``
    of them (counting them runs a job for each number of digits tried).  The
    negatives below a score are those before it in its slice plus the negatives
    before its slice, which add up over the digits: no task orders more than one
    slice, or the values of one digit.
    """
    value = F.col(score).cast("double")
    by_score = (
        scored.where(F.col(label).isNotNull() & value.isNotNull() & ~F.isnan(value))
        .groupBy(value.alias("score"))
        .agg(
            F.count_if(F.col(label) == 1).alias("positives"),
            F.count_if(F.col(label) == 0).alias("negatives"),
        )
    )
    digits = {f"digit_{number}": ordered_digit(F.col("score"), number) for number in range(1, DIGITS + 1)}
    sliced = by_score.withColumns(digits)
    names = list(digits)
    for depth in range(2, DIGITS + 1):
        slices = sliced.groupBy(*names[:depth]).agg(F.count(F.lit(1)).alias("scores"), F.sum("negatives").alias("within"))
        if depth == DIGITS or (slices.agg(F.max("scores")).first()[0] or 0) <= per_slice:
            break
    prefix = names[:depth]
    earlier = Window.partitionBy(*prefix).orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("before") + F.coalesce(F.sum("negatives").over(earlier), F.lit(0))
    twice = (F.col("positives") * (2 * F.col("below") + F.col("negatives"))).cast("decimal(38,0)")
    totals = (
        sliced.join(_before(slices, prefix), prefix)
        .select("positives", "negatives", below.alias("below"))
        .agg(
            F.sum(twice).cast("double").alias("twice"),
            F.sum("positives").cast("double").alias("p"),
            F.sum("negatives").cast("double").alias("n"),
        )
    )
    return totals.select((F.col("twice") / 2 / F.nullif(F.col("p") * F.col("n"), F.lit(0.0))).alias("roc_auc"))


def _before(slices: DataFrame, prefix: list[str]) -> DataFrame:
    """(digits, before): what ``within`` adds up to in all slices below each slice."""
    outer, last = prefix[:-1], prefix[-1]
    lower = Window.partitionBy(*(outer or [F.lit(0)])).orderBy(last).rowsBetween(Window.unboundedPreceding, -1)
    own = slices.select(*prefix, F.coalesce(F.sum("within").over(lower), F.lit(0)).alias("before"))
    if not outer:
        return own
    groups = _before(slices.groupBy(*outer).agg(F.sum("within").alias("within")), outer)
    groups = groups.withColumnRenamed("before", "before_group")
    return own.join(groups, outer).select(*prefix, (F.col("before") + F.col("before_group")).alias("before"))
