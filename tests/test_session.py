import pytest

from ludomart import session


def test_settings_reach_a_session_made_elsewhere(spark, settings):
    settings(spark__sql__session__timeZone="America/New_York")
    session.tune(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_workspace_is_below_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = session.workspace(spark, "x"), session.workspace(spark, "x")
    assert first.startswith(f"{base}/x-") and first != second


def test_workspace_needs_a_shared_folder_on_a_cluster():
    class Conf:
        def get(self, key, default):
            return default

    class Cluster:
        conf = Conf()

        class sparkContext:
            master = "yarn"

    with pytest.raises(RuntimeError):
        session.workspace(Cluster(), "x")


def test_a_query_leaves_the_session_as_it_is(spark):
    """The initial number of shuffle tasks does not hang on what ran before."""
    from ludomart.catalog import QUERIES

    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(initial, None), spark.conf.get("spark.sql.shuffle.partitions")
    for sf in ("0.001", "0.01"):
        plan = QUERIES["dim_time"](spark, f"/root/testdata/sf{sf}")._jdf.queryExecution().toString()
        assert "RoundRobin" not in plan
    assert (spark.conf.get(initial, None), spark.conf.get("spark.sql.shuffle.partitions")) == before
