"""Session settings the plans are designed for."""

from kpiloom.session import RECOMMENDED_CONF, cluster_conf


def test_local_session_uses_recommended_settings(spark):
    for key, value in RECOMMENDED_CONF.items():
        assert spark.conf.get(key).lower() in (value.lower(), str(10 << 20)), key
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"
    assert spark.sparkContext.getCheckpointDir()


def test_cluster_conf_sizes_partitions():
    conf = cluster_conf(input_bytes=100 << 40, executor_cores=8000)
    partitions, split = (int(conf[k]) for k in ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes"))
    assert partitions == 20_480
    map_tasks = (100 << 40) // split
    assert 8 * map_tasks * partitions < 64 << 30  # bytes of shuffle index in all
    small = cluster_conf(input_bytes=1 << 20, executor_cores=100)
    assert small["spark.sql.shuffle.partitions"] == "100"
    assert small["spark.sql.adaptive.enabled"] == "true"
