from tallystone.demo import spread
from tallystone.session import shared_dir

from helpers import rows_of


def test_a_table_is_dealt_out_only_if_its_splits_leave_cores_idle(spark):
    folder = shared_dir(spark, "test-spread")
    numbers = spark.range(8000)
    numbers.coalesce(1).write.parquet(f"{folder}/one")
    numbers.repartition(32).write.parquet(f"{folder}/many")
    numbers.filter("id < 0").write.parquet(f"{folder}/none")

    def dealt(rows):
        assert rows_of(spread(rows)) == rows_of(rows)
        return "Rebalance" in spread(rows)._jdf.queryExecution().optimizedPlan().toString()

    assert dealt(spark.read.parquet(f"{folder}/one"))
    assert not dealt(spark.read.parquet(f"{folder}/many"))
    assert not dealt(spark.read.parquet(f"{folder}/none"))
