"""Every query of the library against its SQL, at the smallest size."""

import os
import random

import duckdb
import pandas as pd
import pytest

from loam.plans.catalog import ORACLES, QUERIES

SF = os.environ.get("LOAM_TEST_SF", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def rows(df: pd.DataFrame) -> list:
    df = df[sorted(df.columns)]
    plain = lambda v: None if v is None or v is pd.NA or v != v else round(float(v), 9) if isinstance(v, (int, float)) or hasattr(v, "dtype") else str(v)
    return sorted((tuple(plain(v) for v in r) for r in df.itertuples(index=False)), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    got, expected = QUERIES[name](spark, SF).toPandas(), db.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert rows(got) == rows(expected)


def test_shares_at_the_limit_are_summed_in_order(spark, tmp_path):
    """Orders of exactly 10 hundredths, one without a key, whose lines lie in two files: only the order of lines decides."""
    rng, lines = random.Random(3), ([], [])
    for k in range(600):
        rest = 0
        while not (found := [(rest // d, d) for d in range(1, 11) if rest > 0 and rest % d == 0 and rest // d <= 50]):
            order = [(rng.randint(1, 50), rng.randint(0, 10)) for _ in range(5)]
            rest = 1000 - sum(q * d for q, d in order)
        for i, (q, d) in enumerate([*order, found[0]]):
            lines[i // 3].append((k or None, float(q), d / 100))
    lines[0].append((1, None, 0.1))
    os.mkdir(tmp_path / "lineitem.parquet")
    for i, part in enumerate(lines):
        pd.DataFrame(part, columns=["l_orderkey", "l_quantity", "l_discount"]).astype({"l_orderkey": "Int64"}).to_parquet(tmp_path / f"lineitem.parquet/{i}.parquet")
    one = duckdb.connect(config={"threads": 1})
    one.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    expected = rows(one.execute(ORACLES["text_overlay_flag"]).df())
    assert len(expected) == 601 and len({r[0] for r in expected}) == 2
    assert rows(QUERIES["text_overlay_flag"](spark, str(tmp_path)).toPandas()) == expected
