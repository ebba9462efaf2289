import duckdb
import pytest

from quire.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return None if v != v else round(v, 6)
    return v


def rows(table):
    names = sorted(table.column_names)
    return names, sorted((tuple(plain(v) for v in r) for r in zip(*(table.column(n).to_pylist() for n in names), strict=True)), key=repr)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, name):
    got = catalogue.QUERIES[name](spark, SF).toArrow()
    if name not in catalogue.ORACLES:
        assert got.num_rows
        return
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    assert rows(got) == rows(con.execute(catalogue.ORACLES[name]).to_arrow_table())
