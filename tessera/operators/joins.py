"""Joins, membership and set operations.

Strategy is left to Catalyst/AQE (runtime size decides broadcast vs
sort-merge); an explicit broadcast hint is only placed on sides whose size is
bounded by construction (a top-k vocabulary, a per-partition offset table).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.ranking import row_position


def enrich(tx: DataFrame, identity: DataFrame, key: str) -> DataFrame:
    """Left equi-join, every transaction kept."""
    return tx.join(identity, key, "left")


def select_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Keep rows whose key is in ``ids`` (semi join: no duplication, no id columns added)."""
    return df.join(ids.select(key), key, "left_semi")


def exclude_ids(df: DataFrame, key: str, *id_frames: DataFrame) -> DataFrame:
    """Rows whose key is in none of the id lists (anti join, null-safe unlike NOT IN)."""
    out = df
    for ids in id_frames:
        out = out.join(ids.select(key), key, "left_anti")
    return out


def attach_labels(df: DataFrame, labels: DataFrame, key: str, label: str) -> DataFrame:
    """C4: inner join with the label table, label column first."""
    joined = df.join(labels.select(key, label), key, "inner")
    return joined.select(label, *[c for c in joined.columns if c != label])


def zip_rows(a: DataFrame, b: DataFrame, pos_col: str = "pos") -> DataFrame:
    """Pair the i-th row of ``a`` with the i-th row of ``b``.

    File-backed inputs are numbered in file order (path, then place in the
    file); see :func:`tessera.operators.ranking.row_position`.
    """
    pa = row_position(a, pos_col)
    pb = row_position(b, pos_col)
    return pa.join(pb, pos_col, "inner")


def lookup_ids(tokens: DataFrame, vocab: DataFrame, token_col: str = "token", id_col: str = "token_id",
               unk_id: int = 0) -> DataFrame:
    """Dictionary lookup with a default id for unknown tokens.

    No hint: adaptive execution broadcasts the vocabulary when its measured size
    allows it and splits frequent tokens otherwise.
    """
    out = tokens.join(vocab.select(token_col, id_col), token_col, "left")
    return out.withColumn(id_col, F.coalesce(F.col(id_col), F.lit(unk_id)))


def known_pairs(pairs: DataFrame, known_a: DataFrame, known_b: DataFrame, a: str = "src", b: str = "dst",
                word: str = "word") -> DataFrame:
    """Keep a pair only if both of its words are known on their side."""
    out = pairs.join(known_a.select(F.col(word).alias(a)), a, "left_semi")
    return out.join(known_b.select(F.col(word).alias(b)), b, "left_semi")


def union_all(*dfs: DataFrame) -> DataFrame:
    """Concatenate by column name (missing columns become null)."""
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), dfs)


def distinct_values(df: DataFrame, col: str, sort: bool = True) -> DataFrame:
    """Distinct values of one column, optionally sorted."""
    out = df.select(col).distinct()
    return out.orderBy(col) if sort else out
