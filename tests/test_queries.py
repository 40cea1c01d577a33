"""Every query with SQL gives DuckDB's rows; the others run."""

import duckdb
import pytest

from transitloom import queries as own

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents labels".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(own.QUERIES))
def test_query(spark, duck, name):
    df = own.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(repr(tuple(r)) for r in df.select(*[f"`{c}`" for c in cols]).collect())
    if name in own.ORACLES:
        sql = duck.sql(own.ORACLES[name])
        assert sorted(sql.columns) == cols
        assert got == sorted(repr(tuple(r)) for r in sql.select(", ".join(f'"{c}"' for c in cols)).fetchall())


def test_shuffled_calls_give_the_same_runs(spark):
    from transitloom.operators import sequence

    rows = [(1, i, p, p in "xy") for i, p in enumerate("axxyab")] + [(2, i, "x", True) for i in range(3)]
    df = spark.createDataFrame(rows, "trip long, ord int, place string, target boolean")
    want = {("x", 2, False, 1), ("y", 2, False, 1)}
    assert {tuple(r) for r in sequence.impacts(df.repartition(3)).collect()} == want


def test_clusters_join_the_first_near_one(spark):
    from pyspark.sql import functions as F

    from transitloom.operators import match

    points = F.array(*[F.struct(F.lit(i).cast("long").alias("ord"), F.lit(lat).alias("lat"), F.lit(15.0).alias("lon")) for i, lat in enumerate((50.0, 50.01, 50.004, 50.008))])
    sizes = spark.range(1).select(F.transform(match.clusters(points), F.size).alias("s")).first()["s"]
    assert sizes == [3, 1]  # the last point is near a member of the first cluster too, which comes first


def test_towns_that_later_spellings_share(spark):
    sf = SF.replace("sf0.001", "sf0.01")  # the smallest table whose numbers meet in a town
    sql = own.ORACLES["promoted_towns"].replace("FROM supplier", f"FROM '{sf}/supplier.parquet'")
    assert [tuple(r) for r in own.promoted_towns(spark, sf).collect()] == duckdb.sql(sql).fetchall() == [(32,)]
