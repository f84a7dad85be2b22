"""Completion rewards (F9, F10): format check and countdown-equation check."""

from __future__ import annotations

import ast
import operator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# The completion format and the allowed equation characters.
FORMAT_PATTERN = r"(?s)^<think>([^<]*(?:<(?!/?think>)[^<]*)*)</think>\n<answer>([\s\S]*?)</answer>$"
ANSWER_PATTERN = r"<answer>(.*?)</answer>"
ALLOWED_PATTERN = r"^[\d+\-*/().\s]+$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def format_reward(completion) -> Column:
    """1.0 when ``"<think>" + completion`` is exactly ``<think>..</think>\\n<answer>..</answer>``."""
    return F.concat(F.lit("<think>"), _c(completion)).rlike(FORMAT_PATTERN).cast("double")


_OPS = {ast.Add: operator.add, ast.Sub: operator.sub, ast.Mult: operator.mul, ast.Div: operator.truediv}


def _eval(node):
    """Whitelisted arithmetic evaluator (numbers, + - * /, unary minus, parentheses)."""
    if isinstance(node, ast.Expression):
        return _eval(node.body)
    if isinstance(node, ast.Constant) and isinstance(node.value, (int, float)):
        return node.value
    if isinstance(node, ast.BinOp) and type(node.op) in _OPS:
        return _OPS[type(node.op)](_eval(node.left), _eval(node.right))
    if isinstance(node, ast.UnaryOp) and isinstance(node.op, (ast.USub, ast.UAdd)):
        v = _eval(node.operand)
        return -v if isinstance(node.op, ast.USub) else v
    raise ValueError("disallowed expression")


@F.pandas_udf(DoubleType())
def _equation_value(eq: pd.Series) -> pd.Series:
    out = []
    for s in eq:
        try:
            out.append(float(_eval(ast.parse(s.strip(), mode="eval"))))
        except Exception:  # noqa: BLE001  (any failure scores 0, as in the reference)
            out.append(float("nan"))
    return pd.Series(out)


def equation_reward(completion, target, nums) -> Column:
    """1.0 when the answer uses exactly the given numbers (as a multiset), only
    digits/operators/parentheses/spaces, and evaluates within 1e-5 of the target.
    A number beyond 38 digits or a target that is no number scores 0."""
    full = F.concat(F.lit("<think>"), _c(completion))
    has = full.rlike(ANSWER_PATTERN)
    eq = F.trim(F.regexp_extract(full, ANSWER_PATTERN, 1))
    used = F.array_sort(F.transform(F.regexp_extract_all(eq, F.lit(r"(\d+)"), 1), lambda x: F.coalesce(x.try_cast("decimal(38,0)"), F.lit(-1).cast("decimal(38,0)"))))
    same = used == F.array_sort(F.transform(_c(nums), lambda x: x.cast("decimal(38,0)")))
    allowed = eq.rlike(ALLOWED_PATTERN)
    ok = has & same & allowed
    val = _equation_value(F.when(ok, eq))
    good = ok & ~F.isnan(val) & F.coalesce(F.abs(val - _c(target).try_cast("double")) < 1e-5, F.lit(False))
    return F.when(good, 1.0).otherwise(0.0)


def group_reward_stats(df, prompt: str, reward: str):
    """each completion's reward with the mean and standard deviation of its prompt's rewards and the
    advantage ``(reward - mean) / (std + 1e-4)`` (std 0 for a single completion)."""
    stats = df.groupBy(prompt).agg(
        F.avg(reward).alias("reward_mean"), F.coalesce(F.stddev_samp(reward), F.lit(0.0)).alias("reward_std"))
    out = df.join(stats, prompt)
    return out.withColumn("advantage", (F.col(reward) - F.col("reward_mean")) / (F.col("reward_std") + 1e-4))
