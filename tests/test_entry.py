"""Driver contract and the independent SQL check on the smallest tables."""

import duckdb
import math

import pytest

import __spark_entry__ as ent
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def test_entry_runs(spark):
    df = ent.entry(spark)
    assert df.count() > 0
    assert "market_share_pct" in df.columns


def test_every_query_has_oracle():
    text_operators = set(ent.llm.QUERIES) if ent.llm else set()
    assert set(ent.queries()) - text_operators == set(ent.oracle_sql()) - text_operators
    assert set(ent.oracle_sql()) <= set(ent.queries())
    assert len(ent.queries()) >= 100


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if v is None:
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    try:
        import decimal
        if isinstance(v, decimal.Decimal):
            return float(f"{float(v):.9g}")
    except Exception:
        pass
    return v


def _rows(records, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.mark.parametrize("key", ["srt1_retention_ordered", "srt2_state_top100", "srt3_state_cuisine_ordered", "srt7_weekday_and_tier_order"])
def test_order_matches_oracle(spark, con, key):
    df = ent.queries()[key](spark, SF_SMALL)
    sql = f"select {', '.join(df.columns)} from ({ent.oracle_sql()[key]})" + (" order by place" if "place" in df.columns else "")
    got = [tuple(map(_norm, r)) for r in df.collect()]
    assert got and got == [tuple(map(_norm, r)) for r in con.execute(sql).fetchall()]


@pytest.mark.parametrize("key", sorted(set(ent.oracle_sql()) - set(ent.llm.QUERIES if ent.llm else ())))
def test_query_matches_oracle(spark, con, key):
    df = ent.queries()[key](spark, SF_SMALL)
    cols = df.columns
    got = _rows([tuple(r) for r in df.collect()], cols)
    cur = con.execute(ent.oracle_sql()[key])
    ocols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(ocols)
    assert got == _rows(cur.fetchall(), ocols)
