"""Window / ordered operators (W1-W9) and the per-key recurrences they rest on.

Per-key windows put one key's rows in one task.  Where a key can be very
long (one user, one sensor holding a third of the table) the operators take
a ``chunk`` column (e.g. the day): windows then run per ``(key, chunk)`` and a
small carry table - one row per chunk - stitches the chunks together.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tessera.functions.dates import epoch_micros
from tessera.operators.ranking import global_row_number
from tessera.session import cut_lineage


#: Open rows of orders (W5) that one task decides in order once no more are left.
ORDER_REST = 500_000


def _cols(x) -> list:
    return [x] if isinstance(x, (str, Column)) else list(x)


def _with_carry(df: DataFrame, carry: DataFrame, keys: list, cols: list[str]) -> DataFrame:
    """``df`` with ``cols`` of its chunk's row in ``carry``; null keys and chunks match each other."""
    right = carry.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *cols)
    on = None
    for i, k in enumerate(keys):
        part = F.col(k).eqNullSafe(F.col(f"_k{i}"))
        on = part if on is None else on & part
    return df.join(right, on, "left").drop(*[f"_k{i}" for i in range(len(keys))])


# ------------------------------------------------------------------ lag

def add_lag(df: DataFrame, key, order, col: str, out: str | None = None, wrap: bool = False,
            chunk: str | None = None) -> DataFrame:
    """``out = lag(col)`` per key; ``wrap=True`` gives the first row the key's last value
    (the reference's rotate-by-one).  ``chunk`` splits long keys (see module doc)."""
    keys, order = _cols(key), _cols(order)
    out = out or f"{col}_lag"
    if chunk is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        res = df.withColumn(out, F.lag(col).over(w))
        if wrap:
            last = F.last(col).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
            res = res.withColumn(out, F.when(F.row_number().over(w) == 1, last).otherwise(F.col(out)))
        return res
    wc = Window.partitionBy(*keys, chunk).orderBy(*order)
    res = df.withColumn(out, F.lag(col).over(wc)).withColumn("_first", F.row_number().over(wc) == 1)
    order_struct = F.struct(*order)
    carry = df.groupBy(*keys, chunk).agg(F.max_by(F.col(col), order_struct).alias("_last"))
    wk = Window.partitionBy(*keys).orderBy(chunk)  # one row per chunk
    carry = carry.withColumn("_prev", F.lag("_last").over(wk))
    if wrap:  # only the key's first chunk wraps; a null carried from an earlier chunk stays null
        final = F.last("_last").over(wk.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        carry = carry.withColumn("_prev", F.when(F.row_number().over(wk) == 1, final).otherwise(F.col("_prev")))
    res = _with_carry(res, carry, [*keys, chunk], ["_prev"])
    return res.withColumn(out, F.when(F.col("_first"), F.col("_prev")).otherwise(F.col(out))).drop("_first", "_prev")


# ------------------------------------------------------- running sums

def cumulative_sum(df: DataFrame, key, order, cols: list[str], chunk: str | None = None,
                   suffix: str = "_cum") -> DataFrame:
    """Running sum per key in ``order`` (inclusive).  With ``chunk`` the window is per
    ``(key, chunk)`` plus the totals of earlier chunks from a one-row-per-chunk table."""
    keys, order = _cols(key), _cols(order)
    if chunk is None:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.select("*", *[F.sum(c).over(w).alias(c + suffix) for c in cols])
    wc = Window.partitionBy(*keys, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    res = df.select("*", *[F.sum(c).over(wc).alias("_l_" + c) for c in cols])
    tot = df.groupBy(*keys, chunk).agg(*[F.sum(c).alias("_t_" + c) for c in cols])
    wk = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select(*keys, chunk, *[F.coalesce(F.sum("_t_" + c).over(wk), F.lit(0)).alias("_p_" + c) for c in cols])
    res = _with_carry(res, tot, [*keys, chunk], ["_p_" + c for c in cols])
    return res.select(*df.columns, *[(F.col("_l_" + c) + F.col("_p_" + c)).alias(c + suffix) for c in cols])


def running_balance(df: DataFrame, key, ts: str, id_col: str, amount: str, opening: float = 0.0,
                    out: str = "balance", chunk: str | None = None) -> DataFrame:
    """Balance after each transaction, sequential by ``(ts, id)``."""
    res = cumulative_sum(df, key, [ts, id_col], [amount], chunk=chunk)
    return res.withColumnRenamed(amount + "_cum", out).withColumn(out, F.col(out) + F.lit(opening))


# ---------------------------------------------------- interpolation

def interpolate_linear(df: DataFrame, key, order, col: str, out: str | None = None,
                       zero_is_missing: bool = True, chunk: str | None = None) -> DataFrame:
    """Linear interpolation by row position per key.

    0 (optionally) and null are missing; interior gaps are filled on the line
    between the neighbouring known values, trailing gaps repeat the last known
    value, leading gaps stay null (pandas ``interpolate()`` defaults).  With ``chunk``
    the windows are per ``(key, chunk)`` and the known points nearest to a chunk come
    from a one-row-per-chunk table.
    """
    keys, order = _cols(key), _cols(order)
    out = out or col
    v = F.col(col)
    known = F.when(v.isNotNull() & ((v != 0) if zero_is_missing else F.lit(True)), v)
    d = dense_position(df, keys, order, "_i", chunk).withColumn("_v", known)
    d = d.withColumn("_pt", F.when(F.col("_v").isNotNull(), F.struct(F.col("_i").alias("i"), F.col("_v").alias("v"))))
    parts = keys if chunk is None else [*keys, chunk]
    w = Window.partitionBy(*parts).orderBy(*order)
    d = d.withColumn("_p", F.last("_pt", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    d = d.withColumn("_n", F.first("_pt", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing)))
    if chunk is not None:
        ends = d.groupBy(*parts).agg(F.max("_pt").alias("_hi"), F.min("_pt").alias("_lo"))  # by position
        wk = Window.partitionBy(*keys).orderBy(chunk)
        ends = ends.withColumns({
            "_before": F.last("_hi", ignorenulls=True).over(wk.rowsBetween(Window.unboundedPreceding, -1)),
            "_after": F.first("_lo", ignorenulls=True).over(wk.rowsBetween(1, Window.unboundedFollowing)),
        })
        d = _with_carry(d, ends, parts, ["_before", "_after"])
        d = d.withColumn("_p", F.coalesce("_p", "_before")).withColumn("_n", F.coalesce("_n", "_after")).drop("_before", "_after")
    interp = F.col("_p.v") + (F.col("_n.v") - F.col("_p.v")) * (F.col("_i") - F.col("_p.i")) / (
        F.col("_n.i") - F.col("_p.i"))
    val = (F.when(F.col("_v").isNotNull(), F.col("_v"))
           .when(F.col("_p").isNull(), F.lit(None))
           .when(F.col("_n").isNull(), F.col("_p.v"))
           .otherwise(interp))
    return d.withColumn(out, val.cast("double")).drop("_i", "_v", "_p", "_n", "_pt")


# --------------------------------------------------------- resample

def resample_mean(df: DataFrame, key, ts: str, col: str, unit: str = "day", fill_gaps: bool = True,
                  drop_zero: bool = True) -> DataFrame:
    """Per key mean per calendar period; empty periods inside the key's span
    appear with a null mean (pandas ``resample().mean()``); rows whose mean is 0
    are removed while null rows stay (``!= 0`` keeps NaN)."""
    keys = _cols(key)
    period = F.date_trunc(unit, F.col(ts)).cast("timestamp_ntz")
    agg = df.groupBy(*keys, period.alias("period")).agg(F.avg(col).alias(col))
    if fill_gaps:
        span = agg.groupBy(*keys).agg(F.min("period").alias("_lo"), F.max("period").alias("_hi"))
        grid = span.select(*keys, F.explode(F.sequence("_lo", "_hi", F.expr(f"INTERVAL 1 {unit.upper()}")))
                           .alias("period"))
        agg = grid.join(agg, [*keys, "period"], "left")
    if drop_zero:
        agg = agg.where(F.col(col).isNull() | (F.col(col) != 0))
    return agg


def drop_first(df: DataFrame, key, order, n: int) -> DataFrame:
    """Drop the first ``n`` rows of every key (the reference drops 24 incomplete hours).

    The ``n``-th smallest order value per key is found with a per-task limit
    (``row_number <= n``), so a long key never meets in one task; rows up to it go.
    ``order`` must be unique within a key.
    """
    keys, order = _cols(key), _cols(order)
    w = Window.partitionBy(*keys).orderBy(*order)
    first = df.select(*keys, *order).withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n)
    cut = first.groupBy(*keys).agg(F.max(F.struct(*order)).alias("_cut"))
    return _with_carry(df, cut, keys, ["_cut"]).where(F.struct(*order) > F.col("_cut")).drop("_cut")


# --------------------------------------------------------- orders

def apply_orders(lines: DataFrame, stock: DataFrame, order_col: str = "order_id", item: str = "item_id",
                 qty: str = "qty", stock_qty: str = "quantity_in_stock", block: int = 4096,
                 rest: int = ORDER_REST) -> DataFrame:
    """Atomic multi-line orders in ``order_col`` order, each against the stock left by those before it.

    An order is ``invalid_request`` if a quantity is missing or not positive,
    else ``no_match`` if an item is unknown, else ``insufficient_stock`` if
    some item is asked for beyond what earlier successful orders left, else
    ``success``; nothing of an order is applied unless it succeeds.

    The sequence is decided in rounds.  An open order succeeds when every one
    of its items has room even if all earlier open orders succeed, and fails
    when some item has no room even if they all fail.  The first open order of
    each item chain is always decided, so the rounds end, after as many as the longest chain of orders that
    wait for one another; each is one running sum per item and a cut of the lineage.  The sums run per item and
    block of ``block`` consecutive orders, so an item that is in every order spans tasks.

    A round moves open orders only: those beyond the opening stock never come in, decided ones leave, and what the
    successful ones take is added to what is used before the later rows of the item.  The last ``rest`` open rows or
    fewer, a bounded remainder, are decided one order after the other in one task.
    """
    asked = _asked(lines, stock, order_col, item, qty, stock_qty)
    per = cut_lineage(asked.groupBy(order_col).agg(
        F.sum("_n").alias("n_lines"),
        F.when(F.sum("_bad") > 0, "invalid_request").when(F.count_if(F.col("_s").isNull()) > 0, "no_match")
        .when(F.max(F.col("_q") > F.col("_s")), "insufficient_stock").alias("status")))
    hopeful = global_row_number(per.where("status is null").select(order_col), [order_col], "_no")
    hopeful = hopeful.select(order_col, F.floor(F.col("_no") / block).alias("_blk"))
    own = lines.join(hopeful.select(order_col), order_col, "left_semi")
    # one row per order and item even if the stock names an item twice: the rounds must end
    state = _asked(own, stock, order_col, item, qty, stock_qty).groupBy(order_col, item).agg(F.sum("_q").alias("_q"), F.min("_s").alias("_s"))
    state = cut_lineage(state.join(hopeful, order_col).select(order_col, item, "_blk", "_q", "_s", (F.col("_q") - F.col("_q")).alias("_used")))
    done = None
    while state.limit(rest + 1).count() > rest:
        summed = cumulative_sum(state, item, order_col, ["_q"], chunk="_blk")
        room = summed.select("*", (F.col("_used") + F.col("_q_cum") <= F.col("_s")).alias("_fits"),
                             (F.col("_used") + F.col("_q") > F.col("_s")).alias("_short"))
        verdict = cut_lineage(room.groupBy(order_col).agg(
            F.when(F.max("_short"), False).when(F.min("_fits"), True).alias("_new")).where("_new is not null"))
        done = verdict if done is None else done.union(verdict)
        zero = F.col("_q") - F.col("_q")
        taken = state.join(verdict, order_col, "left").withColumn("_sure", F.when(F.col("_new"), F.col("_q")).otherwise(zero))
        after = cumulative_sum(taken, item, order_col, ["_sure"], chunk="_blk").where("_new is null")
        state = cut_lineage(after.select(order_col, item, "_blk", "_q", "_s", (F.col("_used") + F.col("_sure_cum")).alias("_used")))
    last = _in_order(state, order_col, item)
    done = last if done is None else done.union(last)
    return per.join(done, order_col, "left").select(
        order_col, "n_lines",
        F.coalesce("status", F.when(F.col("_new"), "success").otherwise("insufficient_stock")).alias("status"))


def _in_order(state: DataFrame, order_col: str, item: str) -> DataFrame:
    """The verdicts ``_new`` on the open orders of ``state``, taken one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taken: dict = {}
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        orders, verdicts = [], []
        for order, own in groupby(rows, key=lambda row: row[0]):
            asked = [row[1:] for row in own]
            ok = all(used + taken.get(i, 0) + q <= s for i, q, s, used in asked)
            if ok:
                for i, q, _, _ in asked:
                    taken[i] = taken.get(i, 0) + q
            orders.append(order)
            verdicts.append(ok)
        yield pa.RecordBatch.from_arrays([pa.array(orders, orders_type), pa.array(verdicts, pa.bool_())], [order_col, "_new"])

    orders_type = to_arrow_type(state.schema[order_col].dataType)
    inorder = state.select(order_col, item, "_q", "_s", "_used").repartition(1).sortWithinPartitions(order_col)
    return inorder.mapInArrow(run, f"`{order_col}` {state.schema[order_col].dataType.simpleString()}, _new boolean")


def _asked(lines: DataFrame, stock: DataFrame, order_col: str, item: str, qty: str, stock_qty: str) -> DataFrame:
    """Per order and item the quantity ``_q``, the bad (``_bad``) and all (``_n``) lines, and the opening stock ``_s``."""
    asked = lines.groupBy(order_col, item).agg(
        F.sum(qty).alias("_q"), F.count_if(F.col(qty).isNull() | (F.col(qty) <= 0)).alias("_bad"), F.count(F.lit(1)).alias("_n"))
    return asked.join(stock.select(item, F.col(stock_qty).alias("_s")), item, "left")


def stock_after(lines: DataFrame, stock: DataFrame, statuses: DataFrame, order_col: str = "order_id",
                item: str = "item_id", qty: str = "qty", stock_qty: str = "quantity_in_stock") -> DataFrame:
    """Stock minus the demand of the successful orders (never negative)."""
    ok = lines.join(statuses.where(F.col("status") == "success").select(order_col), order_col, "left_semi")
    demand = ok.groupBy(item).agg(F.sum(qty).alias("_d"))
    return stock.join(demand, item, "left").withColumn(
        stock_qty, F.col(stock_qty) - F.coalesce(F.col("_d"), F.lit(0))).drop("_d")


# ------------------------------------------------------ rolling

MOMENTS = "array<struct<n:bigint,mean:double,m2:double,lo:double,hi:double>>"


def _moments(col: Column, w) -> Column:
    """Count, mean, sum of squared deviations, smallest and largest of ``col`` over a window."""
    n = F.count(col).over(w)
    return F.struct(n.alias("n"), F.avg(col).over(w).alias("mean"), (F.var_pop(col).over(w) * n).alias("m2"),
                    F.min(col).over(w).alias("lo"), F.max(col).over(w).alias("hi"))


def _merged(parts: Column) -> tuple[Column, Column]:
    """Mean and sample deviation of groups of rows from their moments (deviation 0 where all values are equal)."""
    full = F.filter(parts, lambda p: p["n"] > 0)
    total = F.aggregate(full, F.lit(0).cast("long"), lambda acc, p: acc + p["n"])
    mean = F.try_divide(F.aggregate(full, F.lit(0.0), lambda acc, p: acc + p["mean"] * p["n"]), total)
    spread = F.aggregate(full, F.lit(0.0), lambda acc, p: acc + p["m2"] + p["n"] * (p["mean"] - mean) * (p["mean"] - mean))
    equal = F.array_min(F.transform(full, lambda p: p["lo"])) == F.array_max(F.transform(full, lambda p: p["hi"]))
    return mean, F.when(total > 1, F.when(equal, 0.0).otherwise(F.sqrt(spread / (total - 1))))


def rolling_stats(df: DataFrame, key, ts: str, col: str, days: int = 7, blocks: int = 7) -> DataFrame:
    """Trailing ``days`` window (by time, inclusive) mean/std per key and the
    z-score of each value against it (null where all values of the window are equal).

    Time is cut into blocks of ``days / blocks``, so that a window starts at the same place in its first block as it ends
    in its last one, ``blocks`` later.  Windows run per ``(key, block)``: over the block's rows up to a row, and over a
    copy of the first block's rows, moved forward by ``days``, from the row on.  The whole blocks between enter as merged
    moments, one row per block.  No task holds more of a key than two blocks.
    """
    keys = _cols(key)
    span = days * 86_400_000_000
    if span % blocks:
        raise ValueError("blocks must divide the window's microseconds")
    size = span // blocks
    d = df.withColumns({"_t": epoch_micros(ts), "_x": F.col(col).cast("double")}).withColumn("_b", F.floor(F.col("_t") / size))
    by = [*keys, "_b"]
    # rows that leave the window: at or after the place that a row has in its own block
    moved = d.select(*keys, (F.col("_t") + span).alias("_t"), (F.col("_b") + blocks).alias("_b"), F.col("_x").alias("_y"), F.lit(True).alias("_moved"))
    both = d.withColumns({"_y": F.lit(None).cast("double"), "_moved": F.lit(False)}).unionByName(moved.where("_t IS NOT NULL"), allowMissingColumns=True)
    upto, since = Window.partitionBy(*by).orderBy("_t"), Window.partitionBy(*by).orderBy(F.desc("_t"))
    ends = both.withColumns({"_own": _moments(F.col("_x"), upto), "_first": _moments(F.col("_y"), since)}).where("NOT _moved").drop("_y", "_moved")
    whole = d.groupBy(*by).agg(F.struct(F.count("_x").alias("n"), F.avg("_x").alias("mean"), (F.var_pop("_x") * F.count("_x")).alias("m2"),
                                        F.min("_x").alias("lo"), F.max("_x").alias("hi")).alias("_m"))
    between = Window.partitionBy(*keys).orderBy("_b").rangeBetween(1 - blocks, -1)  # a row per block, at most blocks - 1 of them
    inner = whole.where("_b IS NOT NULL").select(*by, (F.collect_list("_m").over(between) if blocks > 1 else F.array().cast(MOMENTS)).alias("_inner"))
    d = _with_carry(ends, inner, by, ["_inner"])
    mean, std = _merged(F.concat(F.array("_own", "_first"), F.coalesce("_inner", F.array().cast(MOMENTS))))
    d = d.withColumns({"roll_mean": mean, "roll_std": std}).drop("_t", "_x", "_b", "_own", "_first", "_inner")
    return d.withColumn("z", F.try_divide(F.col(col) - F.col("roll_mean"), F.col("roll_std")))


def difference(df: DataFrame, key, order, col: str, lag: int = 1, out: str | None = None,
               chunk: str | None = None) -> DataFrame:
    """H5: ``x_t - x_{t-lag}`` per key (first differences can be chunked for hot keys)."""
    out = out or f"{col}_diff"
    if chunk is not None and lag == 1:
        d = add_lag(df, key, order, col, "_lagv", chunk=chunk)
        return d.withColumn(out, F.col(col) - F.col("_lagv")).drop("_lagv")
    w = Window.partitionBy(*_cols(key)).orderBy(*_cols(order))
    return df.withColumn(out, F.col(col) - F.lag(col, lag).over(w))


def _with_halo(df: DataFrame, keys: list, order: list, chunk: str, cols: list[str], n: int) -> DataFrame:
    """``df`` plus, per chunk, copies of the key's last ``n`` rows before it (``_halo`` true; other columns null).

    Each chunk keeps its own last ``n`` rows in an array; a window over the
    one-row-per-chunk table joins the arrays of at most ``n`` chunks back.
    """
    last = Window.partitionBy(*keys, chunk).orderBy(*[F.col(o).desc() for o in order])
    tails = df.select(*keys, chunk, *order, *cols).withColumn("_r", F.row_number().over(last)).where(F.col("_r") <= n)
    tails = tails.groupBy(*keys, chunk).agg(F.array_sort(F.collect_list(F.struct(*order, *cols))).alias("_tail"))
    earlier = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(-n, -1)
    tails = tails.withColumn("_all", F.flatten(F.collect_list("_tail").over(earlier)))
    taken = F.slice("_all", F.greatest(F.size("_all") - n + 1, F.lit(1)), n)
    halo = tails.select(*keys, chunk, F.explode(taken).alias("_h")).select(
        *keys, chunk, *[F.col("_h")[c].alias(c) for c in [*order, *cols]], F.lit(True).alias("_halo"))
    return df.withColumn("_halo", F.lit(False)).unionByName(halo, allowMissingColumns=True)


def moving_average(df: DataFrame, key, order, col: str, n: int, out: str | None = None,
                   with_std: bool = False, chunk: str | None = None) -> DataFrame:
    """H5: trailing ``n``-row mean (and std); the first ``n-1`` rows are null like pandas ``rolling(n)``.

    With ``chunk`` the windows run per ``(key, chunk)``, each chunk with the ``n - 1`` rows before it.
    ``order`` names columns and is unique within a key.
    """
    keys, order = _cols(key), _cols(order)
    parts, src = keys, df
    if chunk is not None and n > 1:
        parts, src = [*keys, chunk], _with_halo(df, keys, order, chunk, [col], n - 1)
    w = Window.partitionBy(*parts).orderBy(*order)
    wr = w.rowsBetween(-(n - 1), 0)
    full = F.count(F.lit(1)).over(wr) == n
    res = src.withColumn(out or f"{col}_ma{n}", F.when(full, F.avg(col).over(wr)))
    if with_std:
        res = res.withColumn(f"{col}_std{n}", F.when(full, F.stddev_samp(col).over(wr)))
    return res if src is df else res.where(~F.col("_halo")).drop("_halo")


def detrend(df: DataFrame, key, x: str, y: str, out: str | None = None) -> DataFrame:
    """H5: residual of the per-key least-squares line ``y ~ x`` (one partial aggregate + join)."""
    keys = _cols(key)
    fit = df.groupBy(*keys).agg(F.regr_slope(y, x).alias("_b"), F.regr_intercept(y, x).alias("_a"))
    return df.join(fit, keys, "left").withColumn(
        out or f"{y}_detrended", F.col(y) - (F.col("_a") + F.col("_b") * F.col(x))).drop("_a", "_b")


def acf(df: DataFrame, key, order, col: str, lags: list[int], chunk: str | None = None) -> DataFrame:
    """H5: autocorrelation per key and lag in the usual estimator form
    ``sum((x_t - m)(x_{t-k} - m)) / sum((x_t - m)^2)`` (null for a constant series).

    With ``chunk`` the lags run per ``(key, chunk)``, each chunk with the rows before it that they reach.
    """
    keys, order = _cols(key), _cols(order)
    m = df.groupBy(*keys).agg(F.avg(col).alias("_m"))
    d = _with_carry(df, m, keys, ["_m"]).withColumn("_c", F.col(col) - F.col("_m"))
    parts = keys
    if chunk is not None:
        parts, d = [*keys, chunk], _with_halo(d, keys, order, chunk, ["_c"], max(lags))
    w = Window.partitionBy(*parts).orderBy(*order)
    d = d.withColumns({f"_l{k}": F.lag("_c", k).over(w) for k in lags})
    d = d.where("NOT _halo") if chunk is not None else d
    agg = d.groupBy(*keys).agg(F.sum(F.col("_c") * F.col("_c")).alias("_den"),
                               *[F.sum(F.col("_c") * F.col(f"_l{k}")).alias(f"_num{k}") for k in lags])
    long = agg.select(*keys, "_den", F.explode(F.array(*[
        F.struct(F.lit(k).alias("lag"), F.col(f"_num{k}").alias("num")) for k in lags])).alias("_e"))
    return long.select(*keys, F.col("_e.lag").alias("lag"), F.try_divide("_e.num", "_den").alias("acf"))


# ----------------------------------------- suffix recurrences

def dense_position(df: DataFrame, key, order, out: str = "_pos", chunk: str | None = None) -> DataFrame:
    """0-based position per key; with ``chunk`` it is a chunked running count (no key-wide task)."""
    if chunk is None:
        w = Window.partitionBy(*_cols(key)).orderBy(*_cols(order))
        return df.withColumn(out, F.row_number().over(w) - 1)
    d = cumulative_sum(df.withColumn("_one", F.lit(1)), key, order, ["_one"], chunk=chunk)
    return d.withColumn(out, F.col("_one_cum") - 1).drop("_one", "_one_cum")


def suffix_discounted_sum(df: DataFrame, key, pos: str, val: str, gamma: float, out: str,
                          block: int = 256) -> DataFrame:
    """``out_t = sum_{k >= t} gamma^(k-t) * val_k`` per key, ``pos`` dense 0-based.

    The rows of a block of ``block`` positions are folded from the right
    (``acc = val + gamma * acc``): nothing is divided, so small ``gamma`` and long
    trajectories only let products go to 0.  Blocks are stitched by the same
    recurrence one level up with ``gamma^block`` per block, recursively until
    one block is left per key; no task holds more than ``block`` rows of a key
    at a time.  A null value counts as 0.
    """
    if block < 2:
        raise ValueError("block must be at least 2 (each level must shrink the sequence)")
    keys = _cols(key)
    g = F.lit(float(gamma))
    d = df.withColumn("_b", F.floor(F.col(pos) / block).cast("long"))
    later = Window.partitionBy(*keys, "_b").orderBy(pos).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    value = F.coalesce(F.col(val).cast("double"), F.lit(0.0))
    d = d.withColumn("_loc", F.aggregate(
        F.reverse(F.collect_list(value).over(later)), F.lit(0.0), lambda acc, x: x + g * acc))
    starts = d.where(F.col(pos) == F.col("_b") * block).select(*keys, F.col("_b").alias("_bp"), F.col("_loc").alias("_L"))
    most = starts.agg(F.max("_bp")).first()[0] or 0
    if most < 1:
        return d.withColumn(out, F.col("_loc")).drop("_b", "_loc")
    # value at the start of every block, from the block-level recurrence
    blk = suffix_discounted_sum(starts, keys, "_bp", "_L", gamma ** block, "_G", block)
    nxt = blk.select(*keys, (F.col("_bp") - 1).alias("_nb"), F.col("_G").alias("_Gnext"))
    nxt = nxt.withColumnRenamed("_nb", "_b")
    d = _with_carry(d, nxt, [*keys, "_b"], ["_Gnext"])
    carry = F.coalesce(F.col("_Gnext") * F.pow(g, (F.col("_b") + 1) * block - F.col(pos)), F.lit(0.0))
    return d.withColumn(out, F.col("_loc") + carry).drop("_b", "_loc", "_Gnext")


def discounted_returns(df: DataFrame, traj, t: str, reward: str, gamma: float, out: str = "G",
                       block: int = 256, chunk: str | None = None) -> DataFrame:
    """``G_t = r_t + gamma * G_{t+1}`` per trajectory, ordered by ``t``."""
    d = dense_position(df, traj, t, "_pos", chunk=chunk)
    return suffix_discounted_sum(d, traj, "_pos", reward, gamma, out, block).drop("_pos")


def gae(df: DataFrame, traj, t: str, logp: str, ref_logp: str, value: str, score: str,
        gamma: float = 1.0, lam: float = 0.95, kl_coef: float = 0.1, block: int = 256, chunk: str | None = None) -> DataFrame:
    """Generalised advantage estimate per trajectory.

    reward_t = -kl_coef * (logp - ref_logp), plus the trajectory's score at its
    last step; delta_t = reward_t + gamma * V_{t+1} - V_t (V after the end = 0);
    A_t = delta_t + gamma * lam * A_{t+1}; returns = A + V.  ``chunk`` (a column, rising with ``t``) splits long trajectories.
    """
    keys = _cols(traj)
    d = add_lead(df.withColumn("_one", F.lit(1)), keys, t, value, "_next_v", chunk=chunk)
    d = add_lead(d, keys, t, "_one", "_more", chunk=chunk)
    d = d.withColumns({"_next_v": F.coalesce("_next_v", F.lit(0.0)), "_last": F.col("_more").isNull()}).drop("_one", "_more")
    reward = -kl_coef * (F.col(logp) - F.col(ref_logp)) + F.when(F.col("_last"), F.col(score)).otherwise(0.0)
    d = d.withColumn("reward", reward).withColumn(
        "_delta", F.col("reward") + gamma * F.col("_next_v") - F.col(value))
    d = dense_position(d, keys, t, "_pos", chunk=chunk)
    d = suffix_discounted_sum(d, keys, "_pos", "_delta", gamma * lam, "advantage", block)
    return d.withColumn("returns", F.col("advantage") + F.col(value)).drop("_next_v", "_last", "_delta", "_pos")


# ------------------------------------------------------ transitions

def add_lead(df: DataFrame, key, order, col: str, out: str | None = None, chunk: str | None = None) -> DataFrame:
    """``out = lead(col)`` per key; with ``chunk`` the last row of a chunk takes the first
    value of the key's next non-empty chunk from a one-row-per-chunk carry table."""
    keys, order = _cols(key), _cols(order)
    out = out or f"{col}_lead"
    if chunk is None:
        return df.withColumn(out, F.lead(col).over(Window.partitionBy(*keys).orderBy(*order)))
    wc = Window.partitionBy(*keys, chunk).orderBy(*order)
    res = df.withColumn(out, F.lead(col).over(wc)).withColumn(
        "_last", F.lead(F.lit(1)).over(wc).isNull())
    carry = df.groupBy(*keys, chunk).agg(F.min_by(F.col(col), F.struct(*order)).alias("_first"))
    carry = carry.withColumn("_next", F.lead("_first").over(Window.partitionBy(*keys).orderBy(chunk)))
    res = _with_carry(res, carry, [*keys, chunk], ["_next"])
    return res.withColumn(out, F.when(F.col("_last"), F.col("_next")).otherwise(F.col(out))).drop("_last", "_next")


def transition_matrix(df: DataFrame, key, order, state: str, chunk: str | None = None) -> DataFrame:
    """Counts and row-normalised probabilities of successive state pairs per key."""
    nxt = add_lead(df, key, order, state, "to_state", chunk=chunk)
    pairs = nxt.select(F.col(state).alias("from_state"), "to_state").where(F.col("to_state").isNotNull())
    counts = pairs.groupBy("from_state", "to_state").agg(F.count(F.lit(1)).alias("n"))
    tot = counts.groupBy("from_state").agg(F.sum("n").alias("_tot"))
    return counts.join(tot, "from_state").withColumn("p", F.col("n") / F.col("_tot")).drop("_tot")
