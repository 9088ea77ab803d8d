"""Session helpers: only the time zone of a caller's session is touched."""

import pytest

from kontor.session import pin_session


def test_pin_session_sets_only_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    pin_session(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "dynamic"
    spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_pin_session_raises_where_utc_cannot_be_set():
    class Conf:
        def set(self, key, value):
            raise ValueError("locked")

    class Session:
        conf = Conf()

    with pytest.raises(ValueError):
        pin_session(Session())


def test_shared_folder_is_the_sessions_or_an_error_on_a_cluster():
    from types import SimpleNamespace

    import pytest

    from kontor.session import shared_folder

    def session(master, configured=None):
        held = {"dir": None}
        sc = SimpleNamespace(
            master=master, getCheckpointDir=lambda: held["dir"], setCheckpointDir=lambda d: held.update(dir=d)
        )
        return SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda key, default: configured))

    assert shared_folder(session("yarn", "hdfs:///x")) == "hdfs:///x"
    assert "kontor-shared-" in shared_folder(session("local[4]")) and shared_folder(session("local"))
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            shared_folder(session(master))
