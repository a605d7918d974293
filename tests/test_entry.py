import duckdb
import pytest

from conftest import SF001
import __spark_entry__ as E
from flowlens.plans.queries import ORACLE, QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["window_end", "rank", "item_id", "cnt"]
    assert df.count() > 0


def test_every_oracle_has_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(ORACLE) == set(QUERIES)  # the stream-analytics catalog has no gap


def _norm(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted(map(tuple, pdf[cols].astype(object).itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    got = _norm(E.queries()[name](spark, SF001).toPandas())
    exp = _norm(con.execute(E.oracle_sql()[name]).df())
    assert got[0] == exp[0]
    assert got[1] == exp[1]


_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
          "BOOLEAN": "boolean"}


def test_column_types_match_oracle(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    for name, sql in ORACLE.items():
        got = dict(E.queries()[name](spark, SF001).dtypes)
        exp = {c[0]: _TYPES.get(c[1], c[1]) for c in con.execute(f"DESCRIBE {sql}").fetchall()}
        assert got == exp, name
