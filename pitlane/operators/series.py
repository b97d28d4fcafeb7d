"""Window operators over car time series, split into bounded blocks.

A series is all rows of one car in one race, ordered by frame.  A naive
``Window.partitionBy(race, pilot)`` puts a whole series into one task; with
few cars and long races one series can hold a large share of all rows.  So
every pass here cuts a series into *blocks* of ``block_frames`` consecutive
frame numbers and works per block:

1. A hash aggregate per block keeps what a neighbouring block needs: row
   count, sums, first/last row values, first/last non-null values.  It runs
   partially before its shuffle, so each task sends one small row per block
   it saw -- a hot series costs nothing extra here.
2. The block summaries form a series of their own (one row per block), and
   the *carries* each block needs -- rows and sums before it, last non-null
   value before it, first non-null value after it, the rows just before and
   after it -- are series operations on it.  They are computed by the same
   pass one level up (blocks of ``fan_out`` blocks), and at the top level by
   a plain window over what is left: with two levels that window sees one
   row per ``block_frames * fan_out`` frames of a series.
3. The rows shuffle once on (series, block) -- the only exchange of the full
   data -- and one window per block computes the local result; the carries
   join on (series, block) and patch the block edges.  The window runs
   before the join, so its output (clustered and sorted by series, block,
   frame) feeds a sort-merge join without another sort; AQE makes it a
   broadcast join when it measures the carries small.

A block holds at most ``block_frames`` rows when frames are unique in a
series, so no task buffers more than that however skewed the series sizes.
Rows without a frame share one block per series, and rows without a key one
series: split them off first (``operators.keys``), as the pipeline does.  Rows
that share a frame need ``tiebreak`` columns for a defined order.
Results equal those of an unblocked window over the whole series.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, FractionalType, IntegralType, TimestampNTZType, TimestampType

from pitlane.functions.roles import ORDER_KEY, SERIES_KEYS

DEFAULT_BLOCK_FRAMES = 1 << 16
DEFAULT_FAN_OUT = 1 << 12


@dataclass(frozen=True)
class Series:
    """How rows form ordered series.

    ``keys`` identify a series (a car in a race), ``order`` orders it and
    ``tiebreak`` orders rows sharing a frame number.  ``block_frames`` is the
    width of a block in frame numbers (microseconds for a timestamp order
    key); it bounds the rows a window group buffers.
    ``levels`` is the number of block levels (0: a plain window per series)
    and ``fan_out`` the number of blocks grouped at each further level.
    """

    keys: tuple[str, ...] = SERIES_KEYS
    order: str = ORDER_KEY
    tiebreak: tuple[str, ...] = ()
    block_frames: int = DEFAULT_BLOCK_FRAMES
    levels: int = 2
    fan_out: int = DEFAULT_FAN_OUT

    def __post_init__(self) -> None:
        if self.block_frames < 1 or self.fan_out < 1 or self.levels < 0:
            raise ValueError("block_frames and fan_out must be positive, levels not negative")
        if not self.keys:
            raise ValueError("a series needs at least one key column")

    def ordering(self) -> list[Column]:
        return [F.col(self.order)] + [F.col(c) for c in self.tiebreak]

    def window(self) -> Window:
        """Unblocked window of a whole series (small frames and references)."""
        return Window.partitionBy(*self.keys).orderBy(*self.ordering())


DEFAULT_SERIES = Series()


@dataclass
class _Ops:
    """Series operations as ``{output: input}`` maps (``number``: output name)."""

    forward: dict[str, str] = field(default_factory=dict)  # last non-null at or before
    forward_before: dict[str, str] = field(default_factory=dict)  # ... strictly before
    backward: dict[str, str] = field(default_factory=dict)  # next non-null at or after
    backward_after: dict[str, str] = field(default_factory=dict)  # ... strictly after
    mean: dict[str, str] = field(default_factory=dict)  # null -> mean of both neighbours
    previous: dict[str, str] = field(default_factory=dict)  # lag 1
    following: dict[str, str] = field(default_factory=dict)  # lead 1
    sum_before: dict[str, str] = field(default_factory=dict)  # sum of the rows before (0 if none)
    number: str | None = None  # 1-based row number

    def outputs(self) -> list[str]:
        names: list[str] = []
        for m in (self.forward, self.forward_before, self.backward, self.backward_after, self.mean,
                  self.previous, self.following, self.sum_before):
            names += list(m)
        return names + ([self.number] if self.number else [])


def _as_mapping(cols: Iterable[str] | Mapping[str, str]) -> dict[str, str]:
    """Normalise ``cols`` to ``{output: input}``."""
    if isinstance(cols, Mapping):
        return dict(cols)
    return {c: c for c in cols}


def _uniq(*maps: Mapping[str, str]) -> list[str]:
    return list(dict.fromkeys(v for m in maps for v in m.values()))


# The pass builds a few hundred window and aggregate expressions.  They are
# written as SQL text (one JVM call per column) rather than composed from
# Column objects (one JVM call per function, column and alias), which keeps
# plan construction on the driver fast; Catalyst sees the same expressions.

_RUN = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
_BEFORE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
_MIN_LONG_SQL = "CAST(-9223372036854775808 AS BIGINT)"


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _over(partition: list[str], order: list[str], desc: bool = False, frame: str = "") -> str:
    direction = "DESC NULLS LAST" if desc else "ASC NULLS FIRST"
    ords = ", ".join(f"{o} {direction}" for o in order)
    return f"OVER (PARTITION BY {', '.join(partition)} ORDER BY {ords} {frame})"


def _mean_sql(c: str, prev: str, nxt: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN (CAST({prev} AS DOUBLE) + CAST({nxt} AS DOUBLE)) / 2 ELSE {c} END"


def _project(df: DataFrame, out: dict[str, str]) -> DataFrame:
    """Replace or append ``{name: sql}`` columns, keeping the column order."""
    cols = [f"{out[c]} AS {_q(c)}" if c in out else _q(c) for c in df.columns]
    cols += [f"{sql} AS {_q(n)}" for n, sql in out.items() if n not in df.columns]
    return df.selectExpr(*cols)


def _plain(df: DataFrame, keys: list[str], order: list[str], ops: _Ops) -> DataFrame:
    """The operations as plain windows over whole series (the top level)."""
    part = [_q(k) for k in keys]
    w = _over(part, order)
    run, before = _over(part, order, frame=_RUN), _over(part, order, frame=_BEFORE)
    run_desc, after = _over(part, order, True, _RUN), _over(part, order, True, _BEFORE)
    out: dict[str, str] = {}
    for o, c in ops.forward.items():
        out[o] = f"last({_q(c)}, true) {run}"
    for o, c in ops.forward_before.items():
        out[o] = f"last({_q(c)}, true) {before}"
    for o, c in ops.backward.items():
        out[o] = f"last({_q(c)}, true) {run_desc}"
    for o, c in ops.backward_after.items():
        out[o] = f"last({_q(c)}, true) {after}"
    for o, c in ops.mean.items():
        out[o] = _mean_sql(_q(c), f"lag({_q(c)}) {w}", f"lead({_q(c)}) {w}")
    for o, c in ops.previous.items():
        out[o] = f"lag({_q(c)}) {w}"
    for o, c in ops.following.items():
        out[o] = f"lead({_q(c)}) {w}"
    for o, c in ops.sum_before.items():
        out[o] = f"coalesce(sum({_q(c)}) {before}, 0)"
    if ops.number:
        out[ops.number] = f"CAST(row_number() {w} AS BIGINT)"
    return _project(df, out)


def _order_number(df: DataFrame, order: str) -> str:
    """The order key as a number for block arithmetic (timestamps: microseconds)."""
    if isinstance(df.schema[order].dataType, (TimestampType, TimestampNTZType)):
        return f"unix_micros(CAST({_q(order)} AS TIMESTAMP))"
    return _q(order)


def _summary_order(df: DataFrame, order: str, tiebreak: list[str]) -> str:
    """Row order inside a block for ``min_by``/``max_by``.

    A plain number keeps the aggregate a (partial) HashAggregate; tie-break
    columns need a struct.  Rows without a frame order first.
    """
    if tiebreak:
        return f"struct({', '.join(_q(c) for c in [order, *tiebreak])})"
    dtype = df.schema[order].dataType
    if isinstance(dtype, (IntegralType, TimestampType, TimestampNTZType)):
        return f"coalesce(CAST({_order_number(df, order)} AS BIGINT), {_MIN_LONG_SQL})"
    if isinstance(dtype, FractionalType) and not isinstance(dtype, DecimalType):
        return f"coalesce(CAST({_q(order)} AS DOUBLE), CAST('-Infinity' AS DOUBLE))"
    return f"struct({_q(order)})"


def _blocked(
    df: DataFrame,
    keys: list[str],
    order: str,
    tiebreak: list[str],
    width: int,
    levels: int,
    fan_out: int,
    ops: _Ops,
    level: int = 0,
) -> DataFrame:
    order_sql = [_q(order)] + [_q(c) for c in tiebreak]
    if levels <= 0:
        return _plain(df, keys, order_sql, ops)

    p = f"_pl{level}_"
    key, blk, n = p + "series", p + "block", p + "n"
    K, B = _q(key), _q(blk)
    # A block is a run of ``width`` frame numbers: monotone in the frame, so a
    # contiguous piece of the series order.  Rows without a frame sort first.
    blocked = df.selectExpr(
        "*",
        f"struct({', '.join(_q(k) for k in keys)}) AS {K}",
        f"coalesce(CAST(floor({_order_number(df, order)} / {int(width)}) AS BIGINT), {_MIN_LONG_SQL}) AS {B}",
    )
    ordering = _summary_order(df, order, tiebreak)

    fwd = _uniq(ops.forward, ops.forward_before)
    bwd = _uniq(ops.backward, ops.backward_after)
    heads = _uniq(ops.mean, ops.following)  # need the first row of the next block
    tails = _uniq(ops.mean, ops.previous)  # need the last row of the previous block
    sums = _uniq(ops.sum_before)
    ix = {name: {c: i for i, c in enumerate(cols)} for name, cols in
          (("f", fwd), ("b", bwd), ("h", heads), ("t", tails), ("s", sums))}

    # 1. one summary row per block (partial aggregation before the shuffle)
    aggs = [f"count(1) AS {_q(n)}"]
    for i, c in enumerate(fwd):
        aggs.append(f"max_by({_q(c)}, CASE WHEN {_q(c)} IS NOT NULL THEN {ordering} END) AS {p}lnn{i}")
    for i, c in enumerate(bwd):
        aggs.append(f"min_by({_q(c)}, CASE WHEN {_q(c)} IS NOT NULL THEN {ordering} END) AS {p}fnn{i}")
    for i, c in enumerate(heads):
        aggs.append(f"min_by({_q(c)}, {ordering}) AS {p}first{i}")
    for i, c in enumerate(tails):
        aggs.append(f"max_by({_q(c)}, {ordering}) AS {p}last{i}")
    for i, c in enumerate(sums):
        aggs.append(f"sum({_q(c)}) AS {p}sum{i}")
    summary = blocked.groupBy(key, blk).agg(*[F.expr(a) for a in aggs])

    # 2. carries: series operations over the blocks, one level up
    carry_ops = _Ops(
        forward_before={f"{p}cf{i}": f"{p}lnn{i}" for i in range(len(fwd))},
        backward_after={f"{p}cb{i}": f"{p}fnn{i}" for i in range(len(bwd))},
        previous={f"{p}cp{i}": f"{p}last{i}" for i in range(len(tails))},
        following={f"{p}cn{i}": f"{p}first{i}" for i in range(len(heads))},
        sum_before={f"{p}cs{i}": f"{p}sum{i}" for i in range(len(sums))},
    )
    if ops.number:
        carry_ops.sum_before[f"{p}off"] = n
    carries = _blocked(summary, [key], blk, [], fan_out, levels - 1, fan_out, carry_ops, level + 1)
    carries = carries.select(key, blk, *carry_ops.outputs())

    # 3. local windows per block, then the carries patch the block edges
    part = [K, B]
    w = _over(part, order_sql)
    run, before = _over(part, order_sql, frame=_RUN), _over(part, order_sql, frame=_BEFORE)
    run_desc, after = _over(part, order_sql, True, _RUN), _over(part, order_sql, True, _BEFORE)
    rn, last_row = p + "rn", p + "last_row"
    loc: dict[str, str] = {}
    if ops.number or tails:
        loc[rn] = f"row_number() {w}"
    if heads:
        loc[last_row] = f"lead(1) {w} IS NULL"
    for m, frame in ((ops.forward, run), (ops.forward_before, before), (ops.backward, run_desc), (ops.backward_after, after)):
        for o, c in m.items():
            loc[p + "L" + o] = f"last({_q(c)}, true) {frame}"
    for i, c in enumerate(tails):
        loc[f"{p}lag{i}"] = f"lag({_q(c)}) {w}"
    for i, c in enumerate(heads):
        loc[f"{p}lead{i}"] = f"lead({_q(c)}) {w}"
    for o, c in ops.sum_before.items():
        loc[p + "L" + o] = f"sum({_q(c)}) {before}"
    joined = blocked.selectExpr("*", *[f"{sql} AS {_q(name)}" for name, sql in loc.items()]).join(
        carries, [key, blk], "left"
    )

    def prev_of(c: str) -> str:
        i = ix["t"][c]
        return f"CASE WHEN {_q(rn)} = 1 THEN {p}cp{i} ELSE {p}lag{i} END"

    def next_of(c: str) -> str:
        i = ix["h"][c]
        return f"CASE WHEN {_q(last_row)} THEN {p}cn{i} ELSE {p}lead{i} END"

    out: dict[str, str] = {}
    for m in (ops.forward, ops.forward_before):
        for o, c in m.items():
            out[o] = f"coalesce({_q(p + 'L' + o)}, {p}cf{ix['f'][c]})"
    for m in (ops.backward, ops.backward_after):
        for o, c in m.items():
            out[o] = f"coalesce({_q(p + 'L' + o)}, {p}cb{ix['b'][c]})"
    for o, c in ops.mean.items():
        out[o] = _mean_sql(_q(c), prev_of(c), next_of(c))
    for o, c in ops.previous.items():
        out[o] = prev_of(c)
    for o, c in ops.following.items():
        out[o] = next_of(c)
    for o, c in ops.sum_before.items():
        out[o] = f"coalesce({_q(p + 'L' + o)}, 0) + coalesce({p}cs{ix['s'][c]}, 0)"
    if ops.number:
        out[ops.number] = f"CAST({p}off + {_q(rn)} AS BIGINT)"

    columns = df.columns
    cols = [f"{out[c]} AS {_q(c)}" if c in out else _q(c) for c in columns]
    cols += [f"{sql} AS {_q(o)}" for o, sql in out.items() if o not in columns]
    return joined.selectExpr(*cols)


def series_pass(
    df: DataFrame,
    series: Series = DEFAULT_SERIES,
    *,
    forward: Iterable[str] = (),
    backward: Iterable[str] = (),
    mean: Iterable[str] = (),
    previous: Iterable[str] | Mapping[str, str] = (),
    following: Iterable[str] | Mapping[str, str] = (),
    number: str | None = None,
) -> DataFrame:
    """All series window operators in one shuffle of the rows.

    * ``forward``: null becomes the last non-null value up to the row.
    * ``backward``: null becomes the next non-null value from the row on.
    * ``mean``: a null becomes ``(previous + next) / 2`` of its direct
      neighbours (null unless both are present); the column becomes double.
    * ``previous`` / ``following``: ``{out: col}`` lag / lead by one row.
    * ``number``: 1-based row number within the series (bigint).

    Filled columns keep their name and position; the column sets must be
    disjoint, since each fill reads the unfilled values.
    """
    ops = _Ops(
        forward=_as_mapping(forward),
        backward=_as_mapping(backward),
        mean=_as_mapping(mean),
        previous=_as_mapping(previous),
        following=_as_mapping(following),
        number=number,
    )
    filled = list(ops.forward) + list(ops.backward) + list(ops.mean)
    if len(set(filled)) != len(filled):
        raise ValueError("a column can take only one fill")
    outputs = ops.outputs()
    if len(set(outputs)) != len(outputs):
        raise ValueError("two operations write the same output column")
    if not ops.outputs():
        return df
    return _blocked(
        df, list(series.keys), series.order, list(series.tiebreak),
        series.block_frames, series.levels, series.fan_out, ops,
    )


# --- single operators, each one pass of the above ---------------------------


def ordered(df: DataFrame, series: Series = DEFAULT_SERIES) -> DataFrame:
    """Globally ordered by series key, then frame (a range shuffle).

    Only for outputs that must be ordered; no window needs it first.
    """
    return df.orderBy(*series.keys, *series.ordering())


def forward_fill(df: DataFrame, *cols: str, series: Series = DEFAULT_SERIES) -> DataFrame:
    """Null becomes the last non-null value at or before the row (leading nulls stay)."""
    return series_pass(df, series, forward=cols)


def backward_fill(df: DataFrame, *cols: str, series: Series = DEFAULT_SERIES) -> DataFrame:
    """Null becomes the next non-null value at or after the row (trailing nulls stay)."""
    return series_pass(df, series, backward=cols)


def neighbour_mean(df: DataFrame, *cols: str, series: Series = DEFAULT_SERIES) -> DataFrame:
    """Null becomes the mean of the rows just before and after it.

    Both neighbours must be non-null, so runs of two or more nulls and nulls
    at a series end stay null.  The columns become double.
    """
    return series_pass(df, series, mean=cols)


def lag_lead(
    df: DataFrame,
    previous: Mapping[str, str],
    following: Mapping[str, str],
    series: Series = DEFAULT_SERIES,
) -> DataFrame:
    """``{out: col}`` value of the previous / next row of the series (no default)."""
    return series_pass(df, series, previous=previous, following=following)


def row_number(df: DataFrame, name: str = "row_num", series: Series = DEFAULT_SERIES) -> DataFrame:
    """1-based position of the row in its series (bigint)."""
    return series_pass(df, series, number=name)
