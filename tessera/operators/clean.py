"""Projection, filters and cleaning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.quantiles import exact_percentiles

from tessera.functions.dates import epoch_seconds


def parse_payload(df: DataFrame, schema, col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """B1: JSON text column -> typed top-level columns (``from_json`` + ``data.*``)."""
    keep = keep if keep is not None else [c for c in df.columns if c != col]
    return df.select(*keep, F.from_json(F.col(col).cast("string"), schema).alias("_data")).select(*keep, "_data.*")


def label_first(df: DataFrame, label: str, drop: list[str] = ()) -> DataFrame:
    """B2: drop bookkeeping columns, label column first."""
    rest = [c for c in df.columns if c != label and c not in set(drop)]
    return df.select(label, *rest)


def drop_empty(df: DataFrame) -> DataFrame:
    """Drop rows whose every column is null."""
    return df.dropna(how="all")


def empty_row_report(df: DataFrame) -> DataFrame:
    """Row counts before and after ``drop_empty`` in one pass."""
    any_value = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in df.columns])
    return df.agg(F.count(F.lit(1)).alias("n_before"), F.count_if(any_value).alias("n_after"))


def parse_ts(col, fmts: list[str]) -> Column:
    """Coercing timestamp parse; first matching format wins, no match -> null."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in fmts])


def add_date_parts(df: DataFrame, col: str, prefix: str | None = None, drop: bool = True) -> DataFrame:
    """Calendar parts of a date/timestamp column (day of week 0 = Monday).

    Year, Month, Week (ISO), Day, Dayofweek, Dayofyear, month/quarter/year
    start and end flags, Elapsed (epoch seconds).
    """
    p = prefix if prefix is not None else col
    c = F.col(col)
    d = c.cast("date")
    qstart = F.make_date(F.year(d), (F.quarter(d) - 1) * 3 + 1, F.lit(1))
    parts = {
        "Year": F.year(c), "Month": F.month(c), "Week": F.weekofyear(c), "Day": F.dayofmonth(c),
        "Dayofweek": F.weekday(c), "Dayofyear": F.dayofyear(c),
        "Is_month_end": d == F.last_day(d), "Is_month_start": F.dayofmonth(c) == 1,
        "Is_quarter_end": d == F.date_sub(F.add_months(qstart, 3), 1), "Is_quarter_start": d == qstart,
        "Is_year_end": (F.month(c) == 12) & (F.dayofmonth(c) == 31),
        "Is_year_start": (F.month(c) == 1) & (F.dayofmonth(c) == 1),
        "Elapsed": epoch_seconds(c).cast("long"),
    }
    out = df.select("*", *[v.alias(f"{p}{k}") for k, v in parts.items()])
    return out.drop(col) if drop else out


_LOG = {"log": F.log, "log1p": F.log1p, "log10": F.log10}
_INV = {"log": F.exp, "log1p": F.expm1, "log10": lambda c: F.pow(F.lit(10.0), c)}


def log_target(df: DataFrame, col: str, kind: str = "log", out: str | None = None) -> DataFrame:
    """Log / log1p / log10 target transform."""
    return df.withColumn(out or col, _LOG[kind](F.col(col)))


def unlog(df: DataFrame, col: str, kind: str = "log", out: str | None = None) -> DataFrame:
    """Inverse of :func:`log_target`."""
    return df.withColumn(out or col, _INV[kind](F.col(col)))


def fill_const(df: DataFrame, values: dict) -> DataFrame:
    """Constant fill per column (e.g. 0 for one-hot, ``'NaN'`` for text)."""
    return df.fillna(values)


def fill_median_flag(df: DataFrame, cols: list[str], fit: DataFrame | None = None) -> DataFrame:
    """Exact median fill plus a ``<col>_na`` indicator.

    Medians come from ``fit`` (the training part) when given; each is found by
    distributed ranks, and one value per column reaches the driver.  A column
    without values has no median and stays null.
    """
    src = fit if fit is not None else df
    med = {}
    for c in cols:
        row = exact_percentiles(src, [], c, {"m": 0.5}).first()
        med[c] = row["m"] if row else None
    out = df
    for c in cols:
        out = out.withColumn(f"{c}_na", F.col(c).isNull()).withColumn(
            c, F.coalesce(F.col(c).cast("double"), F.lit(med[c]).cast("double")))
    return out


def profile(df: DataFrame) -> DataFrame:
    """Per-column null count and share in a single pass, long form."""
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = wide.unpivot("__n", cols, "column", "n_null")
    return long.select("column", F.col("__n").alias("n_rows"), "n_null",
                       (F.col("n_null") / F.col("__n")).alias("null_share"))


def label_coverage(df: DataFrame, label: str) -> DataFrame:
    """Rows, labelled/unlabelled counts and share, distinct labels."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(label).alias("n_labelled"),
        F.count_if(F.col(label).isNull()).alias("n_unlabelled"),
        (F.count(label) / F.count(F.lit(1))).alias("labelled_share"),
        F.countDistinct(label).alias("n_labels"),
    )


def _word_in(col: str, word: str) -> Column:
    return F.instr(F.lower(F.coalesce(F.col(col), F.lit(""))), f" {word.lower()} ") > 0


def search_items(df: DataFrame, name: str = "name", description: str = "description", word: str | None = None,
                 exact_name: str | None = None, price: str = "price", max_price: float | None = None,
                 min_price: float | None = None, stock: str = "quantity_in_stock",
                 in_stock: bool = False) -> DataFrame:
    """Keyword search (`` word `` inside lower-cased name OR description),
    exact (case-sensitive) name match, price range and stock filters; only the
    given constraints are applied."""
    conds = []
    if word is not None:
        conds.append(_word_in(description, word) | _word_in(name, word))
    if exact_name is not None:
        conds.append(F.col(name) == exact_name)
    if max_price is not None:
        conds.append(F.col(price) <= max_price)
    if min_price is not None:
        conds.append(F.col(price) >= min_price)
    if in_stock:
        conds.append(F.col(stock) > 0)
    return df.where(reduce(lambda a, b: a & b, conds)) if conds else df


def search_messages(df: DataFrame, *, ts: str = "ts", keyword: str | None = None,
                    text_cols: tuple[str, ...] = ("subject", "body", "sender"), unread_only: bool = False,
                    read_col: str = "read", sender: str | None = None, sender_col: str = "sender",
                    recipient: str | None = None, recipient_col: str = "recipient", start=None, end=None,
                    limit: int | None = None) -> DataFrame:
    """Mailbox filters (keyword, unread, sender, recipient, date range), newest first, optional limit."""
    conds = []
    if keyword is not None:
        kw = keyword.lower()
        conds.append(reduce(lambda a, b: a | b,
                            [F.instr(F.lower(F.coalesce(F.col(c), F.lit(""))), kw) > 0 for c in text_cols]))
    if unread_only:
        conds.append(~F.col(read_col))
    if sender is not None:
        conds.append(F.col(sender_col) == sender)
    if recipient is not None:
        conds.append(F.col(recipient_col) == recipient)
    if start is not None:
        conds.append(F.col(ts) >= F.lit(start))
    if end is not None:
        conds.append(F.col(ts) <= F.lit(end))
    out = df.where(reduce(lambda a, b: a & b, conds)) if conds else df
    out = out.orderBy(F.desc(ts))
    return out.limit(limit) if limit is not None else out


def contains_all(df: DataFrame, arr_col: str, wanted: list) -> DataFrame:
    """Rows whose array holds every wanted value (relational division, array form)."""
    return df.where(F.size(F.array_except(F.array(*[F.lit(w) for w in wanted]), F.col(arr_col))) == 0)


def contains_all_long(df: DataFrame, key: str, value: str, wanted: list) -> DataFrame:
    """B12, long form: keys whose rows cover every wanted value (one partial aggregate)."""
    return (
        df.where(F.col(value).isin(list(wanted)))
        .groupBy(key).agg(F.countDistinct(value).alias("_n"))
        .where(F.col("_n") == len(set(wanted))).select(key)
    )


def simplify_category(col) -> Column:
    """Text before the first comma, trimmed (``'bag, wallet'`` -> ``'bag'``)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.trim(F.split(c, ",", 2)[0])


def annotation_lines(df: DataFrame, file_col: str, width_col: str, height_col: str, objects_col: str,
                     names: dict | None = None) -> DataFrame:
    """One ``name x y w h file W H`` line per object of the wanted categories.

    ``objects_col`` is a struct of parallel arrays ``category`` (names) and
    ``bbox`` (array of 4 numbers); categories outside ``names`` are dropped and
    kept ones use the simplified name.
    """
    exploded = df.select(file_col, width_col, height_col,
                         F.explode(F.arrays_zip(F.col(f"{objects_col}.category").alias("category"),
                                                F.col(f"{objects_col}.bbox").alias("bbox"))).alias("o"))
    cat = simplify_category(F.col("o.category"))
    if names is not None:
        exploded = exploded.where(F.col("o.category").isin(list(names)))
    b = F.col("o.bbox")
    return exploded.select(F.format_string(
        "%s %d %d %d %d %s %d %d", cat, b[0].cast("int"), b[1].cast("int"), b[2].cast("int"), b[3].cast("int"),
        F.col(file_col), F.col(width_col).cast("int"), F.col(height_col).cast("int")).alias("line"))
