"""A sample of queries against their DuckDB oracle at sf0.001 (the full run is tools/check_oracle.py)."""

import math

import duckdb
import pytest

from table_dirs import SF_SMALL
import __spark_entry__ as entry
from tessera.session import TABLES

SAMPLE = ["relation_graph_hubs", "b6_date_parts", "c6_lookup_ids", "d3_rebuild_state", "d9_user_profile",
          "w2_interpolate_linear", "w7_discounted_returns", "v2_auc", "v6_forecast_metrics", "t5_perplexity_laplace_n2",
          "t13_text_nb_scores", "m8_best_split", "k5_silhouette", "q1_split_exact", "t18_nearest"]


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def n(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else round(v, 6)
        return v
    return sorted((tuple(n(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rows, cols = df.collect(), df.columns
    cur = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(dcols)
    assert _norm(rows, cols) == _norm(cur.fetchall(), dcols)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert len(df.collect()) == 10
    assert df.columns == ["relation", "entity", "degree", "n_pairs"]


def test_every_query_has_docstring_or_oracle():
    qs, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(qs)
