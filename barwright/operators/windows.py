"""Window primitives over bars: one row per (symbol, time).

Physical idea.  A bar table has one row per symbol and day (or week), so a
symbol's history is bounded by the calendar: about 26,000 rows a century.  All
primitives therefore share ``PARTITION BY symbol`` and Spark plans a single
exchange for a whole chain of them.

``lay_out`` adds the column ``__era``, a fixed slice of the calendar.  Windows
order by (``__era``, time), which is the same order as by time alone, and the
recursive averages use ``PARTITION BY symbol, __era``.  Both need the rows
sorted by (symbol, __era, time), so the chain also keeps a single sort.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace
from itertools import zip_longest

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

ERA = "__era"
ERA_ROW = "__era_row"
ERA_ENDS = "__era_ends"
ROW = "__row"
NEWEST = "__newest"
CLOSE_WAS = "__close_was"
MONTH_ENDS = "__month_ends"
MONTH_CLOSE = "__mclose"
BASE = "__base"
SEED = "__seed"
HALO = "__halo"
AGE = "__age"  # bars after this one, on seeded frames

# The weights of a recursive average grow by 1/(1-alpha) per bar inside an era
# and must stay below the double range (1e308) with room for the prices.
_MAX_WEIGHT_DIGITS = 280
FASTEST_ALPHA = 1.0 / 3.0  # span 5, the shortest average in the indicator set


def alpha_of_span(n: int) -> float:
    return 2.0 / (n + 1.0)


def era_days(alpha: float, days_per_bar: int = 1) -> int:
    """Longest calendar slice whose weights cannot overflow."""
    if not 0.0 < alpha < 1.0:
        raise ValueError("smoothing factor must lie between 0 and 1")
    return int(_MAX_WEIGHT_DIGITS / -math.log10(1.0 - alpha)) * days_per_bar


@dataclass(frozen=True)
class Bars:
    """Names the time column and hands out the window specs of a laid-out frame."""

    ts: str
    prefix: tuple[str, ...] = (ERA,)
    alpha: float = FASTEST_ALPHA  # fastest average that the eras have room for
    seeded: bool = False  # the frame continues stored states, see plans.rolling
    by: tuple[str, ...] = ("symbol",)  # rows of one window

    def known(self, value: str, field: str) -> str:
        """A value from the frame or, where it has none, from the symbol's stored state."""
        return f"coalesce({value}, {SEED}.{field})" if self.seeded else value

    def own(self, x: str) -> str:
        """A value of rows that the stored state has not seen; NULL on repeated older rows."""
        return f"if({HALO}, null, {x})" if self.seeded else x

    @property
    def order(self) -> WindowSpec:
        return Window.partitionBy(*self.by).orderBy(*self.prefix, self.ts)

    @property
    def upto(self) -> WindowSpec:
        return self.order.rowsBetween(Window.unboundedPreceding, 0)

    @property
    def before(self) -> WindowSpec:
        return self.order.rowsBetween(Window.unboundedPreceding, -1)

    def last(self, n: int) -> WindowSpec:
        return self.order.rowsBetween(1 - n, 0)

    @property
    def era_upto(self) -> WindowSpec:
        return (
            Window.partitionBy(*self.by, ERA)
            .orderBy(self.ts)
            .rowsBetween(Window.unboundedPreceding, 0)
        )

    @property
    def sql_order(self) -> str:
        return f"partition by {', '.join(self.by)} order by {', '.join((*self.prefix, self.ts))}"

    @property
    def sql_upto(self) -> str:
        return f"{self.sql_order} rows between unbounded preceding and current row"

    @property
    def sql_before(self) -> str:
        return f"{self.sql_order} rows between unbounded preceding and 1 preceding"

    @property
    def sql_era_upto(self) -> str:
        return (
            f"partition by {', '.join(self.by)}, {ERA} order by {self.ts}"
            " rows between unbounded preceding and current row"
        )

    @property
    def whole(self) -> WindowSpec:
        return Window.partitionBy("symbol")


PLAIN_DAILY = Bars("date", ())
PLAIN_WEEKLY = Bars("week_start", ())


def lay_out(
    df: DataFrame, ts: str, alpha: float = FASTEST_ALPHA, days_per_bar: int = 1, seeded: bool = False
) -> tuple[DataFrame, Bars]:
    """Add the era, the row counters, the neighbours of each bar and the month-end closes
    in two window passes; what nobody reads is pruned away.

    A month's close is the close of its last bar, known only once a bar of a later
    month exists, so the last bar of the data never counts as a month end.  Of the older rows
    that a seeded frame repeats only the last can be one the stored state does not know."""
    bars = Bars(ts, alpha=alpha, seeded=seeded)
    fresh = f" and not coalesce(lead({HALO}, 1) over ({bars.sql_order}), false)" if seeded else ""
    days = F.datediff(F.col(ts), F.lit("1900-01-01").cast("date"))
    era = F.floor(days / float(era_days(alpha, days_per_bar))).cast("int")
    month = f"year({ts}) * 12 + month({ts})"
    df = (
        df.withColumn(ERA, era)
        .selectExpr(
            "*",
            f"row_number() over ({bars.sql_order}) as {ROW}",
            f"lead({ERA}, 1) over ({bars.sql_order}) as __era_next",
            f"lag(close, 1) over ({bars.sql_order}) as {CLOSE_WAS}",
            f"coalesce(first(close) over ({bars.sql_upto}), 0D) as {BASE}",
            f"coalesce(lead({month}, 1) over ({bars.sql_order}) <> {month}, false){fresh} as {MONTH_ENDS}",
        )
        .selectExpr(
            "*",
            f"coalesce(__era_next <> {ERA}, false) as {ERA_ENDS}",
            f"__era_next is null as {NEWEST}",
            f"if({MONTH_ENDS}, close, null) as {MONTH_CLOSE}",
        )
        .selectExpr(
            "*",
            f"count(1) over ({bars.sql_era_upto}) as {ERA_ROW}",
            f"count({MONTH_CLOSE}) over ({bars.sql_era_upto}) as {MONTH_CLOSE}__m",
        )
        .drop("__era_next")
    )
    return df, bars


def drop_internal(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("__")])


def pack(df: DataFrame, finished: list[str], name: str = "__done") -> DataFrame:
    """Carry finished columns as one struct.  Every window pass re-writes each column
    of its rows; a struct is copied as one block."""
    rest = [c for c in df.columns if c not in finished]
    return df.select(*rest, F.struct(*finished).alias(name))


def unpack(df: DataFrame, name: str = "__done") -> DataFrame:
    return df.select(*[c for c in df.columns if c != name], f"{name}.*")


def run_levels(df: DataFrame, *chains: list[list[str]]) -> DataFrame:
    """Append SQL columns level by level, the chains side by side: columns of one level
    do not depend on each other, so its window functions share one pass."""
    for level in zip_longest(*chains, fillvalue=[]):
        df = df.selectExpr("*", *[column for part in level for column in part])
    return df


# --- sliding frames ---------------------------------------------------------


def sma(x: Column, n: int, bars: Bars) -> Column:
    """Mean of the last n bars; NULL until n values exist."""
    return F.when(F.count(x).over(bars.last(n)) == n, F.avg(x).over(bars.last(n)))


def rolling_std(x: Column, n: int, bars: Bars) -> Column:
    """Sample standard deviation of the last n bars; NULL until n values exist."""
    return F.when(F.count(x).over(bars.last(n)) == n, F.stddev_samp(x).over(bars.last(n)))


STEPS = (1, 4, 16)  # sizes of the blocks that frames are put together from


def _balanced(terms: list[str]) -> str:
    """A sum added up pair by pair, so that n equal terms give n times the term."""
    if len(terms) == 1:
        return terms[0]
    half = (len(terms) + 1) // 2
    return f"({_balanced(terms[:half])} + {_balanced(terms[half:])})"


def sliding(
    df: DataFrame, bars: Bars, means: Mapping[str, tuple[str, int]], deviations: Mapping[str, tuple[str, int]] | None = None
) -> DataFrame:
    """Append means and sample standard deviations of the last n bars (output -> (SQL input, n)),
    the figures of ``sma`` and ``rolling_std``, for long frames and many of them.

    A frame that slides is added up anew on every row.  Here each row adds up its last four bars once,
    four such blocks to one of sixteen, and a frame is put together from every sixteenth row's block and
    what is over: three passes of lags.  Every distance of a lag is compiled by itself, so there are few of
    them: ten up to 79 bars.  Values are only ever added, so nothing is left behind by bars that have
    gone out of the frame, and a missing value makes a sum NULL just as long as it is in the frame."""
    deviations = dict(deviations or {})
    kept = [f"`{c}`" for c in df.columns]
    values = {x: f"__v{i}" for i, x in enumerate(dict.fromkeys(x for x, _ in [*means.values(), *deviations.values()]))}
    spread = {values[x] for x, _ in deviations.values()}
    needed: list[dict[tuple[str, int], None]] = [{} for _ in STEPS]  # (value, bars) to add up, by level

    def require(v: str, n: int) -> None:
        if n > 1:
            level = max(i for i, step in enumerate(STEPS) if step < n)
            needed[level][v, n] = None
            for size, _ in _blocks(n, STEPS[level]):
                require(v, size)

    for x, n in [*means.values(), *deviations.values()]:
        require(values[x], n)
    df = df.selectExpr("*", *[f"cast({x} as double) as {v}" for x, v in values.items()])
    for step, wanted in zip(STEPS, needed, strict=True):
        lags: dict[str, str] = {}
        sums = []
        for v, n in wanted:
            parts = []
            for size, k in _blocks(n, step):
                columns = [_total(v, size), *([_spread(v, size)] if v in spread and size > 1 else [])]
                if k:
                    lags |= {f"{c}_{k}": f"lag({c}, {k}) over ({bars.sql_order})" for c in columns}
                parts.append((size, *[f"{c}_{k}" if k else c for c in columns]))
            total = _added(n, step, [part[1] for part in parts])
            sums.append(f"{total} as {_total(v, n)}")
            if v in spread:
                sums.append(f"{_squares(parts, f'({total} / {n}D)')} as {_spread(v, n)}")
        here = df.columns
        df = df.selectExpr("*", *[f"{lag} as {name}" for name, lag in lags.items()]).selectExpr(*[f"`{c}`" for c in here], *sums)
    results = [f"{_total(values[x], n)} / {n}D as {out}" for out, (x, n) in means.items()]
    for out, (x, n) in deviations.items():
        squares = _spread(values[x], n) if n > 1 else "0D"
        results.append(f"sqrt({squares} / nullif({n}D - 1D, 0D)) as {out}")
    return df.selectExpr(*kept, *results)


def _blocks(n: int, step: int) -> list[tuple[int, int]]:
    """The last n bars as whole blocks and, before them, what is over: (bars, how far back)."""
    over = n % step
    return [(step, step * j) for j in range(n // step)] + ([(over, n - over)] if over else [])


def _added(n: int, step: int, totals: list[str]) -> str:
    """Whole blocks pair by pair and then the rest, so that n equal values give n times the value."""
    whole = _balanced(totals[: n // step])
    return f"({whole} + {totals[-1]})" if n % step else whole


def _total(v: str, n: int) -> str:
    return f"{v}s{n}" if n > 1 else v


def _spread(v: str, n: int) -> str:
    return f"{v}q{n}"


def _squares(parts: list[tuple], mean: str) -> str:
    """Squared distances from the mean: inside the blocks, and of the blocks' own means."""
    inside = [part[2] for part in parts if len(part) > 2]
    return _balanced([*inside, *[f"{n}D * ({total} / {n}D - {mean}) * ({total} / {n}D - {mean})" for n, total, *_ in parts]])


def rolling_high(x: Column, n: int, bars: Bars) -> Column:
    return F.max(x).over(bars.last(n))


def rolling_low(x: Column, n: int, bars: Bars) -> Column:
    return F.min(x).over(bars.last(n))


def previous(x: Column, k: int, bars: Bars) -> Column:
    return F.lag(x, k).over(bars.order)


def pct_change(x: Column, bars: Bars) -> Column:
    """Change against the previous bar as a fraction."""
    prev = F.lag(x, 1).over(bars.order)
    return x / F.nullif(prev, F.lit(0.0)) - 1.0


def true_range(close_was: Column) -> Column:
    """Largest of high-low and the two gaps to the previous close.  ``greatest``
    ignores the NULLs of the first bar, which leaves high-low there."""
    high, low = F.col("high"), F.col("low")
    return F.greatest(high - low, F.abs(high - close_was), F.abs(low - close_was))


# --- state over time --------------------------------------------------------


def carry_forward(x: Column, bars: Bars) -> Column:
    """Last non-NULL value so far."""
    return F.last(x, ignorenulls=True).over(bars.upto)


def carried_before(x: Column, bars: Bars) -> Column:
    """Last non-NULL value strictly before this bar."""
    return F.last(x, ignorenulls=True).over(bars.before)


def latch(on: Column, off: Column, bars: Bars) -> Column:
    """1 after an ``on`` event, 0 after an ``off`` event, 0 before any event."""
    event = F.when(on, F.lit(1)).when(off, F.lit(0))
    return F.coalesce(carry_forward(event, bars), F.lit(0))


def changed(state: Column, bars: Bars) -> Column:
    """True on the first bar of each run of equal states."""
    prev = F.lag(state, 1).over(bars.order)
    return prev.isNull() | (prev != state)


def run_number(starts: Column, bars: Bars) -> Column:
    """Number of the run a bar belongs to, given its first-bar marker."""
    return F.sum(starts.cast("int")).over(bars.upto)


def running_peak(x: str, run: str, ts: str) -> Column:
    """Maximum so far inside a run."""
    inside = Window.partitionBy("symbol", run).orderBy(ts)
    return F.max(x).over(inside.rowsBetween(Window.unboundedPreceding, 0))


# --- recursive averages -----------------------------------------------------


@dataclass(frozen=True)
class Counter:
    """SQL expressions of a series: how many values exist up to a row, in all and in its era
    (the latter may be ahead by a constant, as only its differences matter), the value to be
    averaged, and the constant that is taken off before the mean is formed."""

    seen: str
    in_era: str
    value: str | None = None
    base: str | None = None


def _seen(bars: Bars, x: str) -> str:
    return f"(coalesce({SEED}.counts.{x}, 0) + {x}__n)" if bars.seeded else f"{x}__n"


def value_counters(
    df: DataFrame, bars: Bars, columns: Iterable[str], differences: Iterable[str] = ()
) -> tuple[DataFrame, dict[str, Counter]]:
    """Counters of columns that may lack values on some rows, also inside their history.  Prices are
    averaged as differences from the symbol's first close; ``differences`` names the columns that
    are differences already."""
    names = list(dict.fromkeys(columns))
    counts = [
        part
        for x in names
        for part in (
            f"count({bars.own(x)}) over ({bars.sql_upto}) as {x}__n",
            f"count({bars.own(x)}) over ({bars.sql_era_upto}) as {x}__m",
        )
    ]
    return df.selectExpr("*", *counts), {
        x: Counter(_seen(bars, x), f"{x}__m", bars.own(x), None if x in differences else BASE) for x in names
    }


def month_counter(df: DataFrame, bars: Bars) -> tuple[DataFrame, Counter]:
    """For the month-end closes, which exist on some of the rows only."""
    x = MONTH_CLOSE
    df = df.selectExpr("*", f"count({x}) over ({bars.sql_upto}) as {x}__n")
    return df, Counter(_seen(bars, x), f"{x}__m", x, BASE)


def recursive_means(
    df: DataFrame, bars: Bars, specs: Mapping[str, tuple[str, float, Counter]]
) -> DataFrame:
    """Recursive means ``e = (1-a)*e + a*x``, seeded with the first value of x.

    ``specs`` maps an output to (input column, a, counter of the input).  A row
    without a value keeps the mean of the row before, so the same code averages a
    series that exists only on some rows, such as month ends, or bars without a close: these
    neither count nor decay.  With a = 1 the mean is the last value.  An a above that of the
    layout would overflow and is refused.

    Inside an era the recursion is a weighted running sum.  What earlier eras
    contribute is folded from one (sum, length) pair per era, so the work per row
    does not depend on the length of the history.  Two window passes in all.

    Where the counter names a base, the sums are of differences from it (or from the stored mean
    that a seeded frame goes on from): the mean of a constant price is that price to the last
    digit.

    The expressions are SQL text because a plan of this size is otherwise built from
    thousands of driver round trips."""
    sums, pairs, totals = [], [], []
    for out, (x, a, counter) in specs.items():
        value, stored = counter.value or x, f"{SEED}.means.{out}"
        if a >= 1.0:
            sums.append(f"last({value}, true) over ({bars.sql_upto}) as {out}__s")
            totals.append(f"{bars.known(f'{out}__s', f'means.{out}')} as {out}")
            continue
        if a > bars.alpha + 1e-12:
            raise ValueError(f"{out}: lay the bars out for a smoothing factor of {a:.3f}")
        keep, rows = f"{1.0 - a!r}D", f"cast({counter.in_era} as double)"
        decay, here, before, shift = f"pow({keep}, {rows})", f"coalesce({out}__s, 0D)", "0D", ""
        if counter.base is not None:
            base = f"coalesce({stored}, {counter.base})" if bars.seeded else counter.base
            value, shift = f"({value} - {base})", f"{base} + "
        elif bars.seeded:
            before = f"coalesce({stored}, 0D)"
        weight = f"if({counter.seen} = 1, 1D, {a!r}D) * pow({keep}, -{rows})"
        sums.append(f"sum({weight} * {value}) over ({bars.sql_era_upto}) as {out}__s")
        pairs.append(f"'{out}', named_struct('part', {here} * {decay}, 'decay', {decay})")
        carried = f"aggregate(__past, {before}, (acc, e) -> acc * e.{out}.decay + e.{out}.part)"
        totals.append(
            f"if({counter.seen} > 0, {shift}{decay} *"
            f" if(size(__past) = 0, {here}{f' + {before}' if before != '0D' else ''}, {here} + {carried}), null) as {out}"
        )
    if not pairs:
        return df.selectExpr("*", *sums).selectExpr(*[f"`{c}`" for c in df.columns], *totals)
    past = f"collect_list(if({ERA_ENDS}, named_struct({', '.join(pairs)}), null))"
    kept = [f"`{c}`" for c in df.columns]
    return (
        df.selectExpr("*", *sums)
        .selectExpr("*", f"{past} over ({bars.sql_before}) as __past")
        .selectExpr(*kept, *totals)
    )


def ema(
    df: DataFrame, bars: Bars, specs: Mapping[str, tuple[str, int]], differences: Iterable[str] = ()
) -> DataFrame:
    """Exponential means by span n; NULL until n values have been seen.  Spans below five need
    bars laid out for them: ``lay_out(..., alpha=alpha_of_span(n))``."""
    kept = [f"`{c}`" for c in df.columns]
    df, counts = value_counters(df, bars, [x for x, _ in specs.values()], differences)
    raw = recursive_means(
        df, bars, {out: (x, alpha_of_span(n), counts[x]) for out, (x, n) in specs.items()}
    )
    return raw.selectExpr(
        *kept, *[f"if({counts[x].seen} >= {n}, {out}, null) as {out}" for out, (x, n) in specs.items()]
    )


def gains_and_losses(x: str, prev: str) -> tuple[str, str]:
    """The upward and the downward part of a step; NULL for the first value."""
    return tuple(
        f"if({x} - {prev} is null, null, greatest({step}, 0D))"
        for step in (f"{x} - {prev}", f"{prev} - {x}")
    )


def rsi_from_means(gain: str, loss: str) -> str:
    """Relative strength index from smoothed gains and losses; NULL if both are 0."""
    return (
        f"case when {loss} > 0 then 100D - 100D / (1D + {gain} / nullif({loss}, 0D))"
        f" when {gain} > 0 then 100D end"
    )


def wilder_rsi(
    df: DataFrame, bars: Bars, x: str, n: int, out: str
) -> DataFrame:
    """RSI of column x with smoothing factor 1/n; NULL until n differences exist.  A row
    without a value takes no step; the next value's step is from the last value."""
    kept = [f"`{c}`" for c in df.columns]
    up, down = gains_and_losses(x, "__x_was")
    df = df.selectExpr("*", f"last({x}, true) over ({bars.sql_before}) as __x_was").selectExpr(
        "*", f"{up} as __up", f"{down} as __down"
    )
    df, counts = value_counters(df, bars, ["__up"], differences=["__up"])
    counter = counts["__up"]
    fallen = replace(counter, value=bars.own("__down"))  # as many as of the other, but its own values
    df = recursive_means(
        df, bars, {"__gain": ("__up", 1.0 / n, counter), "__loss": ("__down", 1.0 / n, fallen)}
    )
    value = rsi_from_means("__gain", "__loss")
    return df.selectExpr(*kept, f"if({counter.seen} >= {n}, {value}, null) as {out}")
