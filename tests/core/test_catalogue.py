import pytest

from tests.compare import DATA, agree, needs_data
from tidemill.plans import catalogue, collection  # noqa: F401


@needs_data
@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_agrees_with_sql(spark, name):
    agree(spark, catalogue.QUERIES[name], catalogue.ORACLE[name])


@needs_data
def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0 and DATA
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(catalogue.QUERIES) <= set(entry.queries())


def test_sums_are_exact(spark, tmp_path):
    # As doubles, 1e16 takes the 1 with it, and 200 are left, two pages; in truth it is 201, three.
    rows = [(1, 7, 1e16), (2, 7, 1.0), (3, 7, -1e16), (4, 7, 200.0), (5, 7, None), (6, 8, None)]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_totalprice double").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    got = catalogue.QUERIES["q18_shard_blocks"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == [(7, 0, 1, 1), (7, 1, 2, 2), (7, 2, 3, 3)]


def test_a_task_reads_several_splits(spark, tmp_path):
    (tmp_path / "long.txt").write_text("".join(f"line {i}\n" for i in range(20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    with collection._splits(spark, "1k"):
        found = collection.lists.raw_lines(spark, f"{tmp_path}/long.txt")
        assert spark.read.text(f"{tmp_path}/long.txt").rdd.getNumPartitions() <= 5 * spark.sparkContext.defaultParallelism
        assert found.filter("line <> concat('line ', pos)").isEmpty() and found.count() == 20_000
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
