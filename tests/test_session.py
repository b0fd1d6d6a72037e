"""Session helpers: cluster config sizing and the shared scratch folder."""
from ripplelake.session import recommended_conf, scratch_path, shared_dir


def test_recommended_conf_scales_with_input():
    small = recommended_conf(1 << 30, total_cores=64)
    big = recommended_conf(100 << 40, total_cores=8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 128          # 2 x cores floor
    assert int(big["spark.sql.shuffle.partitions"]) == 409600         # 100 TB / 256 MB
    assert big["spark.sql.adaptive.enabled"] == "true"
    assert "RocksDB" in big["spark.sql.streaming.stateStore.providerClass"]


def test_scratch_paths_are_fresh_and_under_shared_dir(spark):
    base = shared_dir(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(base) and b.startswith(base)
