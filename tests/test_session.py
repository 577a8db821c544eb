"""The shared folder comes from the session's checkpoint setting."""

from sentimart.session import scratch_path, shared_dir, ship_package


def test_shared_dir_follows_the_sessions_checkpoint_dir(spark, tmp_path):
    sc = spark.sparkContext
    before = sc.getCheckpointDir()
    try:
        sc.setCheckpointDir(str(tmp_path / "ckpt"))
        d = shared_dir(spark)
        assert d.endswith(sc.getCheckpointDir().rstrip("/").split("/")[-1])
        assert str(tmp_path / "ckpt") in d
        a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
        assert a != b and a.startswith(d)
    finally:
        if before:
            sc.setCheckpointDir(before)


def test_ship_package_once_per_application(spark):
    from sentimart import session
    ship_package(spark)
    n = len(session._SHIPPED)
    ship_package(spark)
    assert len(session._SHIPPED) == n and spark.sparkContext.applicationId in session._SHIPPED
