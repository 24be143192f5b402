"""Session helpers."""

from __future__ import annotations

import os

from daybook.session import checkpoint_root, local_path, use_utc


def test_use_utc_pins_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    use_utc(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_checkpoint_root_is_the_configured_folder(spark):
    root = checkpoint_root(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert root == configured.rstrip("/")
    assert root and not root.endswith("/")
    assert checkpoint_root(spark) == root          # stable across calls


def test_local_path():
    assert local_path("file:/tmp/x") == "/tmp/x"
    assert local_path("s3a://bucket/x") is None
    assert local_path("/tmp/y") == "/tmp/y"
    assert local_path("rel") == os.path.abspath("rel")
