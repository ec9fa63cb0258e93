"""The checkpoint folder comes from the session; ours is used only where none is set."""

from repolens.session import DEFAULT_CONF, ensure_checkpoint_dir


def test_checkpoint_dir_read_from_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    got = ensure_checkpoint_dir(spark)
    assert got
    if named:                                   # the environment names a folder: it is used, not replaced
        assert named.split(":")[-1].rstrip("/") in got   # Spark adds a per-application subfolder
    assert ensure_checkpoint_dir(spark) == got  # stable across calls


def test_session_defaults_keep_the_ui_off():
    assert DEFAULT_CONF["spark.ui.enabled"] == "false"
    assert DEFAULT_CONF["spark.sql.adaptive.enabled"] == "true"
