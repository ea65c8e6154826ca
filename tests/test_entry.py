"""The driver contract, with DuckDB beside Spark at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry
from tessera.plans import carriers, oracles, record_carriers

QUERIES, ORACLES = carriers.QUERIES | record_carriers.QUERIES, oracles.ORACLES | record_carriers.ORACLES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(frame):
    names = sorted(frame.columns)
    out = []
    for row in frame[names].astype(object).itertuples(index=False, name=None):
        out.append(tuple("" if v is None or v != v else str(round(float(v), 6)) if not isinstance(v, (str, bool)) and str(v) not in ("True", "False") else str(v) for v in row))
    return names, sorted(out)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_carrier_equals_its_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.sql(ORACLES[name])
    assert plain(got.toPandas().convert_dtypes().astype(object).where(lambda x: x.notna(), None)) == plain(want.df().convert_dtypes().astype(object).where(lambda x: x.notna(), None))


def test_whole_tables(spark, duck, monkeypatch):
    """All turns are checked, and whole texts normalized."""
    seen, check = [], carriers.validation.sequence_breaks
    monkeypatch.setattr(carriers.validation, "sequence_breaks", lambda rows, *names: (seen.append(rows.count()), check(rows, *names))[1])
    assert carriers.sequence_check(spark, SF).count() > 0
    assert seen == [len(duck.sql("SELECT conv_id FROM conversations").df())]
    longest = max(len(x) for (x,) in duck.sql("SELECT text FROM documents").fetchall())
    assert max(len(r["norm"]) for r in carriers.norm_n3(spark, SF).collect()) >= longest * 0.8


def test_entry(spark):
    assert entry.entry(spark).count() == 4
    assert set(entry.oracle_sql()) <= set(entry.queries())
