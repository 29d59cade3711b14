"""Exact quantiles that stay distributed, by one route for every size.

Order statistics are found by narrowing a bracket around each rank: an
approximate-percentile sketch proposes a smaller bracket, an exact count
accepts it, and the few values left inside are read at the end.  Every pass is
one map-side-combined aggregate for several columns and all their ranks.  What
is returned are elements of the column, infinite ones too.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmentry.functions.expressions import number, quoted

COLUMNS_PER_PASS = 16
SKETCH_ACCURACY = 10_000
FINISH_ROWS = 4_096
BRACKETS_PER_READ = 64


@dataclass(frozen=True)
class OrderStats:
    """Neighbouring order statistics around each requested probability."""

    n: int
    points: dict[float, tuple[float, float, float]]  # prob -> (lower, upper, weight of upper)

    def quantile(self, prob: float, via=lambda v: v) -> float | None:
        """Linear-interpolated quantile of ``via(column)`` for a non-decreasing ``via``.

        A non-decreasing map keeps the order of values, so quantiles of a
        clipped or shifted column follow without another pass.
        """
        if self.n == 0:
            return None
        low, high, weight = self.points[prob]
        low, high = via(low), via(high)
        if low == high or weight == 0.0:  # no difference of infinities
            return low
        return low + (high - low) * weight


@dataclass
class _Bracket:
    col: str
    rank: int
    lo: float
    hi: float
    le_lo: int = 0  # rows <= lo
    lt_hi: int = 0  # rows <  hi
    value: float | None = None

    def settle(self) -> None:
        if self.rank < self.le_lo:
            self.value = self.lo
        elif self.rank >= self.lt_hi:
            self.value = self.hi


def order_statistics(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, OrderStats]:
    """Neighbouring order statistics of each column at each probability (NULLs ignored)."""
    cols, probs = list(cols), [float(p) for p in probs]
    if not cols:
        return {}
    work, ends = _numbered(df, cols)
    counts = {c: n for c, (n, _, _) in ends.items()}
    wanted = {c: sorted({r for p in probs for r in _ranks(p, counts[c])}) if counts[c] else [] for c in cols}
    values = _elements(work, cols, ends, wanted)
    out = {}
    for c in cols:
        points = {}
        if counts[c]:
            for p in probs:
                low, high = _ranks(p, counts[c])
                position = p * (counts[c] - 1)
                points[p] = (values[c, low], values[c, high], min(max(position - low, 0.0), 1.0))
        out[c] = OrderStats(counts[c], points)
    return out


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles per column; ``None`` where a column is all NULL."""
    stats = order_statistics(df, cols, probs)
    return {c: [stats[c].quantile(float(p)) for p in probs] for c in cols}


def element_at(df: DataFrame, col: str, rank: int) -> float | None:
    """The element with ``rank`` smaller or equal ones before it, in ascending order; ``None`` beyond the last."""
    work, ends = _numbered(df, [col])
    if not 0 <= rank < ends[col][0]:
        return None
    return _elements(work, [col], ends, {col: [rank]})[col, rank]


def _numbered(df: DataFrame, cols: list[str]) -> tuple[DataFrame, dict[str, tuple[int, int, int]]]:
    """Columns ``c0, c1, ...`` as doubles, and per column: values, those that are -inf, those below inf."""
    work = df.selectExpr(*[f"CAST({quoted(c)} AS DOUBLE) AS c{i}" for i, c in enumerate(cols)])
    low, high = number(-math.inf), number(math.inf)
    aggs = [a for i in range(len(cols)) for a in (f"count(c{i})", f"count_if(c{i} = {low})", f"count_if(c{i} < {high})")]
    row = work.selectExpr(*aggs).first()
    return work, {c: tuple(row[3 * i : 3 * i + 3]) for i, c in enumerate(cols)}


def _elements(work: DataFrame, cols: list[str], ends: dict, wanted: dict[str, list[int]]) -> dict[tuple[str, int], float]:
    index = {c: i for i, c in enumerate(cols)}
    brackets: list[_Bracket] = []
    for start in range(0, len(cols), COLUMNS_PER_PASS):
        brackets += _narrowed(work, index, cols[start : start + COLUMNS_PER_PASS], ends, wanted)
    _finish(work, index, [b for b in brackets if b.value is None])
    return {(b.col, b.rank): b.value for b in brackets}


def _ranks(prob: float, n: int) -> tuple[int, int]:
    position = prob * (n - 1)
    low = min(math.floor(position + 1e-9), n - 1)
    return low, min(low + 1, n - 1)


def _narrowed(work, index, part, ends, wanted) -> list[_Bracket]:
    """Brackets of at most ``FINISH_ROWS`` values around the wanted ranks."""
    todo = [_Bracket(c, r, -math.inf, math.inf, ends[c][1], ends[c][2]) for c in part for r in wanted[c]]
    for b in todo:
        b.settle()
    while True:
        wide = [b for b in todo if b.value is None and b.lt_hi - b.le_lo > FINISH_ROWS]
        if not wide:
            break
        # Brackets with the same ends share one sketch.
        shared: dict[tuple, list[_Bracket]] = {}
        for b in wide:
            shared.setdefault((b.col, b.lo, b.hi), []).append(b)
        aggs = []
        for (col, lo, hi), group in shared.items():
            points = []
            for b in group:
                centre, slack = (b.rank - b.le_lo) / (b.lt_hi - b.le_lo), 2.0 / SKETCH_ACCURACY
                points += [max(centre - slack, 0.0), min(centre + slack, 1.0)]
            c = f"c{index[col]}"
            aggs.append(
                f"percentile_approx(CASE WHEN {c} > {number(lo)} AND {c} < {number(hi)} THEN {c} END, "
                f"array({', '.join(map(repr, points))}), {SKETCH_ACCURACY})"
            )
        found = work.selectExpr(*aggs).first()
        _count(
            work,
            index,
            [
                (b, *proposals[2 * j : 2 * j + 2])
                for group, proposals in zip(shared.values(), found)
                for j, b in enumerate(group)
            ],
        )
    return todo


def _count(work, index, proposals) -> None:
    """Count rows at the proposed ends exactly, then keep the part holding the rank."""
    marks = list(dict.fromkeys((b.col, v) for b, lo, hi in proposals for v in (lo, hi)))
    aggs = []
    for col, v in marks:
        c = f"c{index[col]}"
        aggs += [f"count_if({c} < {number(v)})", f"count_if({c} <= {number(v)})"]
    row = work.selectExpr(*aggs).first()
    below = {m: (row[2 * j], row[2 * j + 1]) for j, m in enumerate(marks)}
    for b, lo, hi in proposals:
        (lt_lo, le_lo), (lt_hi, le_hi) = below[b.col, lo], below[b.col, hi]
        if b.rank < lt_lo:
            b.hi, b.lt_hi = lo, lt_lo
        elif b.rank >= le_hi:
            b.lo, b.le_lo = hi, le_hi
        else:
            b.lo, b.le_lo, b.hi, b.lt_hi = lo, le_lo, hi, lt_hi
        b.settle()


def _finish(work, index, brackets) -> None:
    """Read the values left inside each bracket (at most FINISH_ROWS of a bracket, shared ones once)."""
    shared: dict[tuple, list[_Bracket]] = {}
    for b in brackets:
        shared.setdefault((b.col, b.lo, b.hi), []).append(b)
    groups = list(shared.items())
    for start in range(0, len(groups), BRACKETS_PER_READ):
        _read(work, index, groups[start : start + BRACKETS_PER_READ])


def _read(work, index, groups: list[tuple[tuple, list[_Bracket]]]) -> None:
    # As SQL text: one call into the JVM instead of several per bracket.
    tagged = []
    for j, ((col, lo, hi), _) in enumerate(groups):
        c = f"c{index[col]}"
        tagged.append(f"CASE WHEN {c} > {number(lo)} AND {c} < {number(hi)} THEN named_struct('j', {j}, 'v', {c}) END")
    rows = work.selectExpr(f"explode(filter(array({', '.join(tagged)}), t -> t IS NOT NULL)) AS t").groupBy("t.j", "t.v").count().collect()
    values: dict[int, list] = {}
    for r in rows:
        values.setdefault(r["j"], []).append((r["v"], r["count"]))
    for j, (_, group) in enumerate(groups):
        seen, waiting = group[0].le_lo, sorted(group, key=lambda b: b.rank)
        for v, n in sorted(values.get(j, [])):
            seen += n
            while waiting and waiting[0].rank < seen:
                waiting.pop(0).value = v
