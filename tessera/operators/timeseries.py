"""State estimation per key (H1-H4).

H1 has no process noise, so its fold has a closed form in running sums and is
a plain chunked window job.  The filters with process noise (H2, H3) and the
discrete Bayes filter (H4) are genuinely sequential per key: they run as a
grouped pandas fold (one key per group, rows in time order).  With a ``chunk``
column (which must not decrease in the order, e.g. the day) they fold every
``(key, chunk)`` into one composable step, carry the state over one row per chunk,
and replay the chunks from it in parallel, in numpy over whole batches of sorted groups; the streaming twin in :mod:`tessera.streaming` keeps the same state across micro-batches.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.ordered import cumulative_sum


def kalman_scalar(df: DataFrame, key, order, z: str, r: str, x0: float, p0: float,
                  chunk: str | None = None) -> DataFrame:
    """H1: sequential scalar updates ``K = P/(P+R)`` without process noise, in closed form:
    ``1/P_t = 1/P0 + sum 1/R_k`` and ``x_t = P_t (x0/P0 + sum z_k/R_k)``."""
    d = df.withColumn("_ir", 1.0 / F.col(r)).withColumn("_zr", F.col(z) / F.col(r))
    d = cumulative_sum(d, key, order, ["_ir", "_zr"], chunk=chunk)
    p = 1.0 / (F.lit(1.0 / p0) + F.col("_ir_cum"))
    return d.withColumn("P", p).withColumn("x", F.col("P") * (F.lit(x0 / p0) + F.col("_zr_cum"))).drop(
        "_ir", "_zr", "_ir_cum", "_zr_cum")


def _kf_fold(pdf: pd.DataFrame, order: list[str], z: str, r: str | None, a: np.ndarray, q: np.ndarray,
             x0: np.ndarray, p0: np.ndarray, r_const: float) -> pd.DataFrame:
    pdf = pdf.sort_values(order, kind="mergesort")
    x, p = x0.astype(float).copy(), p0.astype(float).copy()
    h = np.zeros((1, len(x)))
    h[0, 0] = 1.0
    n = len(x)
    xs, ps = [], []
    zs = pdf[z].to_numpy(float)
    rs = pdf[r].to_numpy(float) if r else np.full(len(pdf), r_const)
    for zi, ri in zip(zs, rs):
        x = a @ x
        p = a @ p @ a.T + q
        s = (h @ p @ h.T)[0, 0] + ri
        k = (p @ h.T)[:, 0] / s
        x = x + k * (zi - x[0])
        p = (np.eye(n) - np.outer(k, h[0])) @ p
        xs.append(x.copy())
        ps.append(p[0, 0])
    out = pdf.copy()
    out["position"] = [v[0] for v in xs]
    if n > 1:
        out["velocity"] = [v[1] for v in xs]
    out["P"] = ps
    return out


def _fold_groups(states: np.ndarray, group: np.ndarray, advance) -> np.ndarray:
    """Folds the rows of a batch into the states of their groups (``group``: the place in ``states`` of every row, non-decreasing),
    the t-th rows of all groups at once with ``advance(states, rows) -> states``.  Returns the state after every row."""
    after = np.empty((len(group), states.shape[1]))
    if len(group):
        rank = np.arange(len(group)) - np.searchsorted(group, group)
        for rows in np.split(np.argsort(rank, kind="stable"), np.cumsum(np.bincount(rank))[:-1]):
            after[rows] = advance(states[group[rows]], rows)
            states[group[rows]] = after[rows]
    return after


def _lists(m: np.ndarray) -> pa.Array:
    """A list of its numbers for every row."""
    width = m.shape[1]
    return pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1, dtype=np.int32) * width), pa.array(m.ravel()))


def _numbers(lists: pa.Array, width: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _floats(column: pa.Array) -> np.ndarray:
    return column.cast(pa.float64()).to_numpy(zero_copy_only=False)


def _chunked_fold(df: DataFrame, key: str, chunk: str, order: list[str], start: list[float], unit: np.ndarray, step, advance,
                  replay, outputs) -> DataFrame:
    """``df`` with the columns ``outputs(batch, states, places) -> arrays`` (``outputs.schema``) from the state after every row.

    ``step(batch)`` gives the ``advance`` of :func:`_fold_groups` that composes the rows of a ``(key, chunk)`` to one
    step (``unit`` to begin with), ``advance(states, steps)`` moves states over whole chunks, ``replay(batch)`` gives the ``advance``
    that moves the states over rows.  All three passes run over sorted partitions, batch by batch: a task holds one
    batch and the state of the group that it is in, however many groups there are and however long one is.
    """
    kinds = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in (key, chunk))
    last = [F.col(c).asc_nulls_last() for c in order]
    width, size = len(start), len(unit)

    def fold(batches):
        names, states = None, np.empty((1, size + 1))
        for batch in filter(len, batches):
            starts = batch["_i"].to_numpy() == 1
            heads = batch.filter(pa.array(starts)).select([key, chunk])
            states = np.concatenate([states[-1:], np.tile([*unit, 0.0], (len(heads), 1))])
            compose = step(batch)
            _fold_groups(states, np.cumsum(starts), lambda s, rows: np.column_stack([compose(s[:, :-1], rows), s[:, -1] + 1]))
            names = pa.concat_batches([heads] if names is None else [names, heads])
            whole = len(names) - 1  # the last group may go on in the next batch
            yield closed(names.slice(0, whole), states[-1 - whole : -1])
            names = names.slice(whole)
        if names is not None:
            yield closed(names, states[-1:])

    def closed(names: pa.RecordBatch, states: np.ndarray) -> pa.RecordBatch:
        columns = [names[key], names[chunk], pa.array(states[:, -1].astype(np.int64)), _lists(states[:, :-1])]
        return pa.RecordBatch.from_arrays(columns, [key, chunk, "_n", "_step"])

    def carry(batches):
        states = np.empty((1, width + 1))
        for batch in filter(len, batches):
            starts = batch["_i"].to_numpy() == 1
            n, steps = batch["_n"].to_numpy(), _numbers(batch["_step"], size)
            states = np.concatenate([states[-1:], np.tile([*start, 0.0], (int(starts.sum()), 1))])
            first = states[0].copy()
            after = _fold_groups(states, np.cumsum(starts), lambda s, rows: np.column_stack(
                [advance(s[:, :-1], steps[rows]), s[:, -1] + n[rows]]))
            before = np.concatenate([first[None, :], after[:-1]])
            before[starts] = [*start, 0.0]
            columns = [batch[key], batch[chunk], _lists(before)]
            yield pa.RecordBatch.from_arrays(columns, [key, chunk, "_state"])

    def run(batches):
        states = np.empty((1, width + 1))
        for batch in batches:
            head = batch["_state"].is_valid().to_numpy(zero_copy_only=False)
            states = np.concatenate([states[-1:], _numbers(batch["_state"].drop_null(), width + 1)])
            batch, group = batch.filter(pa.array(~head)), np.cumsum(head)[~head]
            move = replay(batch)
            after = _fold_groups(states, group, lambda s, rows: np.column_stack([move(s[:, :-1], rows), s[:, -1] + 1]))
            yield outputs(batch.drop_columns(["_state"]), after[:, :-1], after[:, -1].astype(np.int64) - 1)

    rows = df.withColumn("_i", F.row_number().over(Window.partitionBy(key, chunk).orderBy(*last)))
    steps = rows.mapInArrow(fold, f"{kinds}, _n bigint, _step array<double>")
    steps = steps.withColumn("_i", F.row_number().over(Window.partitionBy(key).orderBy(F.col(chunk).asc_nulls_last())))
    heads = steps.mapInArrow(carry, f"{kinds}, _state array<double>")
    # the head of a chunk comes before its rows
    both = df.withColumn("_state", F.lit(None).cast("array<double>")).unionByName(heads, allowMissingColumns=True)
    both = both.repartition(key, chunk).sortWithinPartitions(key, chunk, F.col("_state").isNull(), *last)
    return both.mapInArrow(run, outputs.schema)


def _columns(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def _kf_chunked(df: DataFrame, key: str, chunk: str, order: list[str], z: str, r: str | None, a: np.ndarray, q: np.ndarray,
                x0: np.ndarray, p0: np.ndarray, r_const: float) -> DataFrame:
    """:func:`_kf_fold` by chunks.  A step is ``(A, b, C, eta, J)``: given the state ``x`` before it, the state after it
    has mean ``A x + b`` and variance ``C``, and its readings weigh ``x`` with the information ``eta, J``."""
    n = len(x0)
    eye, h = np.eye(n), np.eye(n)[0]
    cuts = np.cumsum([n * n, n, n * n, n])

    def parts(flat: np.ndarray):
        f, b, c, eta, j = np.split(flat, cuts, axis=1)
        return f.reshape(-1, n, n), b[:, :, None], c.reshape(-1, n, n), eta[:, :, None], j.reshape(-1, n, n)

    def flat(*arrays: np.ndarray) -> np.ndarray:
        return np.concatenate([x.reshape(len(x), -1) for x in arrays], axis=1)

    def readings(batch: pa.RecordBatch):
        return _floats(batch[z]), _floats(batch[r]) if r else np.full(len(batch), r_const)

    def step(batch: pa.RecordBatch):
        zs, rs = readings(batch)

        def compose(states: np.ndarray, rows: np.ndarray) -> np.ndarray:
            f, b, c, eta, j = parts(states)
            s, zi = (q[0, 0] + rs[rows])[:, None, None], zs[rows][:, None, None]
            gain, seen = q[:, :1] / s, (a.T @ h)[:, None]
            left = eye - gain * h
            f2, b2, c2, eta2, j2 = left @ a, gain * zi, left @ q, seen / s * zi, seen @ seen.T / s
            m = np.linalg.inv(eye + c @ j2)
            fm, mt = f2 @ m, f.transpose(0, 2, 1) @ m.transpose(0, 2, 1)
            return flat(fm @ f, fm @ (b + c @ eta2) + b2, fm @ c @ f2.transpose(0, 2, 1) + c2,
                        mt @ (eta2 - j2 @ b) + eta, mt @ j2 @ f + j)

        return compose

    def advance(states: np.ndarray, steps: np.ndarray) -> np.ndarray:
        x, p = states[:, :n, None], states[:, n:].reshape(-1, n, n)
        f, b, c, eta, j = parts(steps)
        m = f @ np.linalg.inv(eye + p @ j)
        return flat(m @ (x + p @ eta) + b, m @ p @ f.transpose(0, 2, 1) + c)

    def replay(batch: pa.RecordBatch):
        zs, rs = readings(batch)

        def move(states: np.ndarray, rows: np.ndarray) -> np.ndarray:
            x, p = states[:, :n, None], states[:, n:].reshape(-1, n, n)
            x, p = a @ x, a @ p @ a.T + q
            k = p[:, :, :1] / (p[:, 0, 0] + rs[rows])[:, None, None]
            return flat(x + k * (zs[rows] - x[:, 0, 0])[:, None, None], (eye - k * h) @ p)

        return move

    names = ["position", "velocity"][:n] + ["P"]

    def outputs(batch: pa.RecordBatch, states: np.ndarray, places: np.ndarray) -> pa.RecordBatch:
        found = [pa.array(c, from_pandas=True) for c in states[:, : n + 1].T]
        return pa.RecordBatch.from_arrays([*batch.columns, *found], [*batch.schema.names, *names])

    outputs.schema = f"{_columns(df)}, " + ", ".join(f"{c} double" for c in names)
    unit = flat(eye[None], *(np.zeros((1, m)) for m in (n, n * n, n, n * n)))[0]
    return _chunked_fold(df, key, chunk, order, [*x0, *p0.ravel()], unit, step, advance, replay, outputs)


def kalman_cv(df: DataFrame, key: str, order: list[str], z: str, r: str | None = None, r_const: float = 1.0,
              q: float = 0.1, dt: float = 1.0, x0=(0.0, 0.0), p0=None, chunk: str | None = None) -> DataFrame:
    """H2: constant-velocity Kalman filter (state position, velocity) per key, predict then update."""
    a = np.array([[1.0, dt], [0.0, 1.0]])
    qm = np.eye(2) * q
    p0m = np.eye(2) if p0 is None else np.asarray(p0, float)
    x0v = np.asarray(x0, float)
    schema = df.schema.simpleString()[len("struct<"):-1].replace(":", " ") + ", position double, velocity double, P double"

    if chunk is not None:
        return _kf_chunked(df, key, chunk, order, z, r, a, qm, x0v, p0m, r_const)

    def fn(pdf):
        return _kf_fold(pdf, order, z, r, a, qm, x0v, p0m, r_const)

    return df.groupBy(key).applyInPandas(fn, schema)


def kalman_fused(df: DataFrame, key: str, order: list[str], a: str, b: str, q: float = 1.0, r: float = 6.0,
                 x0: float = 0.0, p0: float = 10.0, chunk: str | None = None) -> DataFrame:
    """H3: average two sensors, then a one-state Kalman filter (Q=1, R=6, P0=10 by default)."""
    d = df.withColumn("fused", (F.col(a) + F.col(b)) / 2.0)
    schema = d.schema.simpleString()[len("struct<"):-1].replace(":", " ") + ", position double, P double"

    if chunk is not None:
        return _kf_chunked(d, key, chunk, order, "fused", None, np.eye(1), np.eye(1) * q, np.array([x0]), np.eye(1) * p0, r)

    def fn(pdf):
        return _kf_fold(pdf, order, "fused", None, np.eye(1), np.eye(1) * q, np.array([x0]), np.eye(1) * p0, r)

    return d.groupBy(key).applyInPandas(fn, schema)


def histogram_filter(obs: DataFrame, key: str, order: list[str], measurement: str, world: list[str],
                     p_hit: float = 0.6, p_miss: float = 0.2, step: int = 1, p_move: float = 0.8,
                     chunk: str | None = None) -> DataFrame:
    """H4: discrete Bayes localisation per key: for every observation sense (hit/miss weights,
    normalise) then move ``step`` cells cyclically (exact with ``p_move``, stay otherwise)."""
    n = len(world)
    schema = f"{key} {obs.schema[key].dataType.simpleString()}, step long, belief array<double>"

    w = np.array(world)

    def replay(pdf: pd.DataFrame, belief: np.ndarray, place: int) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="mergesort")
        rows = []
        for i, m in enumerate(pdf[measurement].to_numpy(), place):
            belief = belief * np.where(w == m, p_hit, p_miss)
            belief = belief / belief.sum()
            belief = np.roll(belief, step) * p_move + belief * (1 - p_move)
            rows.append((pdf[key].iloc[0], i, belief.tolist()))
        return pd.DataFrame(rows, columns=[key, "step", "belief"])

    even = np.full(n, 1.0 / n)
    if chunk is None:
        return obs.groupBy(key).applyInPandas(lambda pdf: replay(pdf, even, 0), schema)

    def weights(batch: pa.RecordBatch) -> np.ndarray:
        return np.where(w == np.array(batch[measurement].to_pylist(), object)[:, None], p_hit, p_miss)

    def moved(belief: np.ndarray) -> np.ndarray:
        return np.roll(belief, step, axis=1) * p_move + belief * (1 - p_move)

    def product(batch: pa.RecordBatch):
        hits = weights(batch)

        def compose(states: np.ndarray, rows: np.ndarray) -> np.ndarray:
            m = states.reshape(-1, n, n) * hits[rows][:, :, None]
            return moved(m / m.sum(axis=(1, 2), keepdims=True)).reshape(-1, n * n)

        return compose

    def advance(states: np.ndarray, steps: np.ndarray) -> np.ndarray:
        belief = (steps.reshape(-1, n, n) @ states[:, :, None])[:, :, 0]
        return belief / belief.sum(axis=1, keepdims=True)

    def sense(batch: pa.RecordBatch):
        hits = weights(batch)

        def move(states: np.ndarray, rows: np.ndarray) -> np.ndarray:
            belief = states * hits[rows]
            return moved(belief / belief.sum(axis=1, keepdims=True))

        return move

    def outputs(batch: pa.RecordBatch, states: np.ndarray, places: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch[key], pa.array(places), _lists(states)], [key, "step", "belief"])

    outputs.schema = schema
    return _chunked_fold(obs, key, chunk, order, even.tolist(), np.eye(n).ravel(), product, advance, sense, outputs)
