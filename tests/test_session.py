"""Session helpers: cluster settings never override the session; scratch paths live under the checkpoint dir."""

from pulsevault.session import apply_cluster_conf, ensure_checkpoint_dir, scratch_path


def test_cluster_conf_only_fills_unset_keys(spark):
    from pulsevault.session import CLUSTER_CONF
    saved = {k: spark.conf.get(k, None) for k in CLUSTER_CONF}
    try:
        apply_cluster_conf(spark)
        assert spark.conf.get("spark.sql.shuffle.partitions") == saved["spark.sql.shuffle.partitions"]
        for k, v in saved.items():
            if v not in (None, ""):
                assert spark.conf.get(k) == v  # never overrides what the session set
    finally:  # leave the shared test session as it was
        for k, v in saved.items():
            try:
                if v in (None, ""):
                    spark.conf.unset(k)
                else:
                    spark.conf.set(k, v)
            except Exception:  # noqa: BLE001 — static keys
                pass


def test_scratch_paths_are_unique_and_under_checkpoint_dir(spark):
    root = ensure_checkpoint_dir(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root.rstrip("/")) and b.startswith(root.rstrip("/"))
