"""Session helpers: checkpoint folder comes from the cluster setting; sizing advice."""

from fareline.session import ensure_checkpoint_dir, recommended_conf, session_key, shared_dir


def test_checkpoint_dir_is_read_from_the_session(spark):
    configured = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    got = ensure_checkpoint_dir(spark)
    assert got and (configured is None or got == configured or got.endswith(configured.split(":", 1)[-1]))
    assert shared_dir(spark, "x").startswith(got.rstrip("/"))
    assert session_key(spark) == spark.sparkContext.applicationId


def test_recommended_conf_scales_with_input():
    small = recommended_conf(50 << 20, 8)
    big = recommended_conf(100 << 40, 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
    assert int(big["spark.sql.shuffle.partitions"]) == 400_000
    assert int(big["spark.sql.files.maxPartitionBytes"]) == 1 << 30
    assert int(small["spark.sql.files.maxPartitionBytes"]) == 128 << 20


def test_only_local_masters_get_a_temporary_checkpoint_folder():
    import pytest

    from fareline.session import ensure_checkpoint_dir, is_local

    assert is_local("local") and is_local("local[8]") and not is_local("local-cluster[2,1,1024]") and not is_local("yarn")

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
