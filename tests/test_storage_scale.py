"""What queries write to the shared folder."""

from wearline.bindings import QUERIES
from wearline.bindings import fixtures as fx


def test_tagged_telemetry_is_stored_by_the_denser_codec(spark):
    files = QUERIES["tag_subset"](spark, "/root/testdata/sf0.001").inputFiles()
    assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_rows_of_one_split_are_written_by_group_without_another_sort(spark):
    sf = "/root/testdata/sf0.001"
    rows = fx.telemetry(spark, sf, "train")
    assert sorted(rows.drop("split").collect()) == sorted(fx.split_of(spark, sf, "train").collect())
    plan = rows.select("subset", "s_1").sortWithinPartitions("subset")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1
