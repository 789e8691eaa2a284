"""Exact quantiles by narrowing brackets around the wanted ranks.

A sort or a value buffer would bring a whole column together somewhere. Here the
first pass takes counts, extremes and one mergeable sketch per column, whose rank
error is bounded; its percentiles propose a bracket around each rank. The second
pass counts what lies below and inside. A bracket holds about a thousandth of the
rows, whatever the scale of the values. Once few enough values are left inside, the
third pass counts them by value; larger brackets are narrowed again first. The
number of passes does not depend on the number of columns or probabilities.
Infinite values take their ranks at either end without entering a bracket.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ACCURACY = 10_000
SLACK = 4 / ACCURACY
MAX_VALUES = 20_000


@dataclass
class _Bracket:
    column: str
    rank: int      # zero-based rank among the finite values
    lo: float
    hi: float
    below: int     # finite values under ``lo``
    inside: int

    @property
    def open(self) -> bool:
        return self.lo < self.hi


def _inside(b: _Bracket):
    return (F.col(b.column) >= F.lit(b.lo)) & (F.col(b.column) <= F.lit(b.hi))


def _alike(brackets: list[_Bracket]) -> list[list[_Bracket]]:
    """Brackets by what they span, so that neighbouring ranks share their aggregates."""
    groups: dict[tuple, list[_Bracket]] = {}
    for b in brackets:
        groups.setdefault((b.column, b.lo, b.hi), []).append(b)
    return list(groups.values())


def _propose(df: DataFrame, brackets: list[_Bracket]) -> None:
    """Shrink open brackets by approximate percentiles of what they hold, keeping the rank inside.

    Where one value fills much of a bracket, both percentiles can be its ends, and nothing
    shrinks. Then each end is counted alone: the rank is at it, or lies strictly between the
    two, where the percentiles leave about a thousandth of the bracket.
    """
    groups, held = _alike(brackets), {id(b): b.inside for b in brackets}
    shares = [[max(0.0, min(b.rank - b.below for b in g) / max(1, g[0].inside - 1) - SLACK),
               min(1.0, max(b.rank - b.below for b in g) / max(1, g[0].inside - 1) + SLACK)] for g in groups]
    row = df.agg(*[F.percentile_approx(F.when(_inside(g[0]), F.col(g[0].column)), s, F.lit(ACCURACY)).alias(f"p{i}")
                   for i, (g, s) in enumerate(zip(groups, shares))]).first()
    _narrow(df, [(b, b.lo if s[0] == 0 else row[f"p{i}"][0], b.hi if s[1] == 1 else row[f"p{i}"][1])
                 for i, (g, s) in enumerate(zip(groups, shares)) for b in g])
    for end in (0, 1):
        stuck = [(b, row[f"p{i}"][end], row[f"p{i}"][end]) for i, g in enumerate(groups) for b in g
                 if b.open and b.inside > max(MAX_VALUES, held[id(b)] // 2) and b.lo <= row[f"p{i}"][end] <= b.hi]
        if stuck:
            _narrow(df, stuck)


def _narrow(df: DataFrame, proposals: list[tuple[_Bracket, float, float]]) -> None:
    """Count below and inside the proposed bounds; a rank outside them keeps the other part of its bracket."""
    before = {id(b): (b.lo, b.hi, b.below, b.inside) for b, _, _ in proposals}
    for b, lo, hi in proposals:
        b.lo, b.hi = lo, hi
    groups = _alike([b for b, _, _ in proposals])
    counts = df.agg(*[x for i, g in enumerate(groups) for x in (
        F.count(F.when(F.col(g[0].column) < F.lit(g[0].lo), 1)).alias(f"u{i}"),
        F.count(F.when(_inside(g[0]), 1)).alias(f"n{i}"))]).first()
    for i, b in [(i, b) for i, g in enumerate(groups) for b in g]:
        old = before[id(b)]
        b.below, b.inside = counts[f"u{i}"], counts[f"n{i}"]
        if b.rank < b.below:
            b.lo, b.hi, b.below, b.inside = old[0], math.nextafter(b.lo, -math.inf), old[2], b.below - old[2]
        elif b.rank >= b.below + b.inside:
            b.lo, b.below, b.inside = (math.nextafter(b.hi, math.inf), b.below + b.inside,
                                       old[2] + old[3] - b.below - b.inside)
            b.hi = old[1]


def _finish(df: DataFrame, brackets: list[_Bracket]) -> None:
    """Count the few values inside by value and pick the rank's one."""
    groups = _alike(brackets)
    cells = F.array_compact(F.array(*[
        F.when(_inside(g[0]), F.struct(F.lit(i).alias("bracket"), F.col(g[0].column).alias("v")))
        for i, g in enumerate(groups)]))
    held: dict[int, list] = {}
    for r in df.select(F.explode(cells).alias("c")).groupBy("c.bracket", "c.v").count().collect():
        held.setdefault(r["bracket"], []).append((r["v"], r["count"]))
    for i, g in enumerate(groups):
        values = sorted(held[i])
        for b in g:
            at = b.below
            for v, n in values:
                at += n
                if b.rank < at:
                    b.lo = b.hi = v
                    break


def exact_quantiles(df: DataFrame, columns: Sequence[str],
                    probabilities: Sequence[float]) -> dict[str, list[float | None]]:
    """Quantiles with linear interpolation between the closest ranks.

    Nulls and NaNs do not count. A column without values yields ``None``.
    """
    usable = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in columns])
    finite = {c: F.when(F.abs(c) < F.lit(math.inf), F.col(c)) for c in columns}
    shares = [min(1.0, max(0.0, p + s)) for p in probabilities for s in (-SLACK, SLACK)]
    bounds = usable.agg(*[f for i, c in enumerate(columns) for f in (
        *([F.percentile_approx(finite[c], shares, F.lit(ACCURACY)).alias(f"p{i}")] if shares else []),
        F.count(F.when(F.col(c) == F.lit(-math.inf), 1)).alias(f"under{i}"), F.count(finite[c]).alias(f"n{i}"),
        F.count(c).alias(f"all{i}"), F.min(finite[c]).alias(f"lo{i}"), F.max(finite[c]).alias(f"hi{i}"))]).first()
    brackets: dict[tuple[str, int], _Bracket] = {}
    proposals: dict[tuple[str, int], tuple[_Bracket, float, float]] = {}
    for i, c in enumerate(columns):
        under, n = bounds[f"under{i}"], bounds[f"n{i}"]
        for j, p in enumerate(probabilities if bounds[f"all{i}"] else ()):
            position = p * (bounds[f"all{i}"] - 1)
            for rank in {math.floor(position), math.ceil(position)}:
                if rank < under:
                    lo = hi = -math.inf
                elif rank >= under + n:
                    lo = hi = math.inf
                else:
                    lo, hi = bounds[f"lo{i}"], bounds[f"hi{i}"]
                if (c, rank) in brackets:
                    continue
                brackets[c, rank] = b = _Bracket(c, rank - under, lo, hi, 0, n)
                if b.open and n == bounds[f"all{i}"]:  # the sketch's shares are those of all values
                    low, high = bounds[f"p{i}"][2 * j:2 * j + 2]
                    proposals[c, rank] = (b, lo if shares[2 * j] == 0 else low, hi if shares[2 * j + 1] == 1 else high)
    numbers = usable.select(*[finite[c].alias(c) for c in columns])
    if proposals:
        _narrow(numbers, list(proposals.values()))
    while open_brackets := [b for b in brackets.values() if b.open]:
        few = [b for b in open_brackets if b.inside <= MAX_VALUES]
        if few:
            _finish(numbers, few)
        if many := [b for b in open_brackets if b.inside > MAX_VALUES]:
            _propose(numbers, many)

    result: dict[str, list[float | None]] = {}
    for i, c in enumerate(columns):
        n = bounds[f"all{i}"]
        result[c] = []
        for p in probabilities:
            if not n:
                result[c].append(None)
                continue
            position = p * (n - 1)
            below, above = math.floor(position), math.ceil(position)
            low, high = brackets[c, below].lo, brackets[c, above].lo
            result[c].append(low if low == high else low + (high - low) * (position - below))
    return result


def filter_quantile_band(df: DataFrame, column: str, lower: float = 0.01,
                         upper: float = 0.99) -> DataFrame:
    """Keep rows between two quantiles of a column, both ends included.

    The bounds become literals, so the filter reaches the scan.
    """
    low, high = exact_quantiles(df, [column], [lower, upper])[column]
    return df.filter((F.col(column) >= F.lit(low)) & (F.col(column) <= F.lit(high)))
