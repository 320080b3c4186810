"""Exact discrete quantiles without a sort and without a per-group value table.

Each wanted quantile is held in a bracket of two values, first taken from a
sketch of a sample. Counting the rows below, at and inside its ends tells on
which side the wanted rank lies, so the bracket either yields the value, or
shrinks, and a wrong one is widened again: the sample decides how many steps
are needed, never the result. Each step is one column-pruned scan with a
shuffle of one partial row per column and task. Once the count just taken is
small, the rows strictly inside are gathered by a task, which returns the one
of the wanted rank; repeated values cannot spoil that, because rows equal to an
end are counted apart. The driver sees counts, ends and results only, whatever
the gather limit.

Values are compared in a type that holds them exactly (``common_kind``):
integers beyond 2**53 and decimals stay as they are. The sketch has doubles
inside, so it is given the distances from the low end, which are short once the
bracket is; where its cuts still do not part the values, the bracket is halved.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from decimal import ROUND_FLOOR, Decimal, localcontext
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from .stacking import SLOT, VALUE, common_kind, per_slot, stack_columns

ACCURACY = 10_000
GATHER_LIMIT = 100_000
SAMPLE_SHARE, SAMPLE_SEED = 0.1, 7
# Distances from a probability at which a bracket may start.
SLACKS = (3e-4, 1e-3, 3e-3, 1e-2, 3e-2, 1e-1)


Number = int | float | Decimal


@dataclass
class _Bracket:
    """Ends to count around. The wanted value is known to lie between ``least`` and ``most``."""

    rank: int
    least: Number
    most: Number
    low: Number
    high: Number
    below: int = 0
    inside: int = 0
    value: Number | None = None

    def settle(self, below: int, at_low: int, inside: int, at_high: int) -> None:
        """Use the counts around the bracket; set ``value`` if they decide it."""
        self.below, self.inside = below + at_low, inside
        if self.rank <= below:
            self.most = self.low
            self.low, self.high, self.inside = self.least, self.most, 0
        elif self.rank <= below + at_low:
            self.value = self.low
        elif self.rank <= below + at_low + inside:
            self.least, self.most = self.low, self.high
        elif self.rank <= below + at_low + inside + at_high:
            self.value = self.high
        else:
            self.least = self.high
            self.low, self.high, self.inside = self.least, self.most, 0

    def cut(self, low: Number, high: Number) -> None:
        """Narrow to ends from a sketch of the values inside, or halve if they do not narrow.

        A sketch may round integers and decimals to or past the ends; its doubles
        are values that lie inside.
        """
        if not (low < self.high and high > self.low) or (low <= self.low and high >= self.high):
            if not isinstance(self.low, float):
                low = high = _middle(self.low, self.high)
        self.low, self.high = max(low, self.low), min(high, self.high)


def _middle(low: Number, high: Number) -> Number:
    if isinstance(low, int):
        return (low + high) // 2
    with localcontext(prec=80):
        return ((low + high) / 2).quantize(low, rounding=ROUND_FLOOR)


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    statistics: Sequence[Column] = (),
) -> tuple[dict[str, list[Number | None]], dict[str, Row]]:
    """The smallest value whose cumulative share reaches each probability, per column.

    Nulls are left out, NaN is the largest value; values are compared in the
    ``common_kind`` of the columns. ``statistics`` are aggregates of the stacked
    values, computed in the first scan and returned as one row per column.
    """
    kind = common_kind(df, columns)
    stacked = stack_columns(df, columns, kind=kind)
    rows = _first_scan(stacked, probabilities, statistics)
    result: dict[str, list[Number | None]] = {name: [None] * len(probabilities) for name in columns}
    brackets = {
        (row[SLOT], j): _start(row, p, j)
        for row in rows
        for j, p in enumerate(probabilities)
        if row["_n"]
    }
    quantiles = _Quantiles(stacked, kind, len(columns), len(probabilities))
    while brackets:
        quantiles.count(brackets)
        quantiles.narrow(brackets)
        for (slot, j), bracket in list(brackets.items()):
            if bracket.value is not None:
                result[columns[slot]][j] = bracket.value
                del brackets[slot, j]
    return result, {columns[row[SLOT]]: row for row in rows}


def _around(share: float, slack: float) -> tuple[float, float]:
    return max(share - slack, 0.0), min(share + slack, 1.0)


def _first_scan(stacked, probabilities, statistics) -> list[Row]:
    sampled = F.when(F.rand(SAMPLE_SEED) < SAMPLE_SHARE, F.col(VALUE))
    stacked = stacked.withColumn("_sample", sampled)
    wanted = [q for p in probabilities for slack in SLACKS for q in _around(p, slack)]
    first = stacked.groupBy(SLOT).agg(
        F.count(VALUE).alias("_n"),
        F.count("_sample").alias("_sampled"),
        F.percentile_approx("_sample", wanted, ACCURACY).alias("_cuts"),
        F.min(VALUE).alias("_least"),
        F.max(VALUE).alias("_most"),
        *statistics,
    )
    return first.collect()


def _start(row: Row, probability: float, j: int) -> _Bracket:
    """Bracket four standard errors of the sampled rank to each side."""
    least, most = row["_least"], row["_most"]
    bracket = _Bracket(max(1, math.ceil(probability * row["_n"])), least, most, least, most)
    if row["_sampled"]:
        error = 4 * math.sqrt(probability * (1 - probability) / row["_sampled"]) + 2 / ACCURACY
        level = next((i for i, slack in enumerate(SLACKS) if slack >= error), None)
        if level is not None:
            at = 2 * (j * len(SLACKS) + level)
            low, high = row["_cuts"][at : at + 2]
            with localcontext(prec=80):  # ends are kept within what the type can hold
                bracket.low = max(least, low - _rounding(low))
                bracket.high = min(high + _rounding(high), most)  # in this order, as the most may be NaN
    return bracket


def _rounding(number: Number) -> Number:
    """By how much a sketch may have changed an integer or a decimal."""
    if isinstance(number, float):
        return 0.0
    ulp = math.ulp(float(number))
    if isinstance(number, int):
        return int(ulp)
    with localcontext(prec=80):
        return Decimal(ulp).quantize(number, rounding=ROUND_FLOOR)


@dataclass
class _Quantiles:
    """The scans over stacked values; ``brackets`` are keyed by slot and number of the quantile."""

    stacked: DataFrame
    kind: str
    slots: int
    width: int

    def literals(self, values: Sequence) -> Column:
        return per_slot([F.lit(v).cast(self.kind) for v in values])

    def ends(self, j: int, brackets: dict) -> tuple[Column, Column]:
        """Bracket ends of quantile ``j`` as columns; null where there is none left."""
        held = [brackets.get((slot, j)) for slot in range(self.slots)]
        return self.literals([b and b.low for b in held]), self.literals([b and b.high for b in held])

    def inside(self, j: int, brackets: dict) -> Column:
        low, high = self.ends(j, brackets)
        return F.when((F.col(VALUE) > low) & (F.col(VALUE) < high), F.col(VALUE))

    def bases(self, j: int, brackets: dict) -> list[Number | None]:
        """What is taken off exact values before they are sketched; nothing where the distances could overflow."""
        held = [brackets.get((slot, j)) for slot in range(self.slots)]
        if self.kind == "double":
            return [b and 0.0 for b in held]
        if self.kind == "bigint":
            return [b and (b.low if b.high - b.low < 2**62 else 0) for b in held]
        return [b and (b.low if b.low >= 0 else b.low * 0) for b in held]

    def count(self, brackets: dict) -> None:
        value = F.col(VALUE)
        counts = []
        for j in range(self.width):
            low, high = self.ends(j, brackets)
            # Where both ends are one value, its rows are counted at the low end.
            at_high = (value == high) & (low < high)
            inside = (value > low) & (value < high)
            tests = {"b": value < low, "l": value == low, "i": inside, "h": at_high}
            counts += [F.count_if(test).alias(f"{key}{j}") for key, test in tests.items()]
        for row in self.stacked.groupBy(SLOT).agg(*counts).collect():
            for j in range(self.width):
                if (row[SLOT], j) in brackets:
                    brackets[row[SLOT], j].settle(*(row[f"{key}{j}"] for key in "blih"))

    def narrow(self, brackets: dict) -> None:
        """Pick the value of the wanted rank in small brackets, and cut the large ones down."""
        gather = {k: b for k, b in brackets.items() if b.value is None and 0 < b.inside <= GATHER_LIMIT}
        cut = {k: b for k, b in brackets.items() if b.value is None and b.inside > GATHER_LIMIT}
        steps, order = [], {}
        for j in range(self.width):
            if any(quantile == j for _, quantile in gather):
                ranks = [gather[s, j].rank - gather[s, j].below - 1 if (s, j) in gather else None for s in range(self.slots)]
                rank = F.max(per_slot([F.lit(r).cast("int") for r in ranks]))
                gathered = F.sort_array(F.collect_list(self.inside(j, gather)))
                steps.append(F.get(gathered, rank).alias(f"g{j}"))
            order[j] = sorted(slot for slot, quantile in cut if quantile == j)
            if order[j]:
                shares = [(cut[s, j].rank - cut[s, j].below) / cut[s, j].inside for s in order[j]]
                cuts = [q for share in shares for q in _around(share, 2 / ACCURACY)]
                distance = (self.inside(j, cut) - self.literals(self.bases(j, cut))).cast(self.kind)
                steps.append(F.percentile_approx(distance, cuts, ACCURACY).alias(f"c{j}"))
        if not steps:
            return
        open_ones = {**gather, **cut}
        wanted = [self.inside(j, open_ones).isNotNull() for j in range(self.width)]
        few = self.stacked.filter(reduce(or_, wanted))
        for row in few.groupBy(SLOT).agg(*steps).collect():
            for j in range(self.width):
                key = (row[SLOT], j)
                if key in gather:
                    gather[key].value = row[f"g{j}"]
                elif key in cut:
                    at = 2 * order[j].index(row[SLOT])
                    low, high = row[f"c{j}"][at : at + 2]
                    base = self.bases(j, cut)[row[SLOT]]
                    with localcontext(prec=80):
                        cut[key].cut(base + low - _rounding(low), base + high + _rounding(high))
