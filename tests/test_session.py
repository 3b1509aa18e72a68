"""Intermediate tables go under the cluster's checkpoint folder."""
from pyspark.sql import functions as F

from ridegrid.session import checkpoint_root, reliable_checkpoint, scratch_path


def test_scratch_and_cuts_live_under_the_checkpoint_dir(spark):
    root = checkpoint_root(spark)
    assert root == spark.sparkContext.getCheckpointDir()
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:  # the session's own setting wins over anything we would pick
        assert configured.rstrip("/").split(":")[-1] in root
    assert scratch_path(spark, "x").startswith(root.rstrip("/") + "/x-")
    df = spark.range(10).withColumn("k", F.col("id") % 3)
    cut = reliable_checkpoint(df)
    assert sorted(tuple(r) for r in cut.collect()) == sorted(tuple(r) for r in df.collect())
    assert all(f.startswith(root.rstrip("/")) or root.split(":")[-1] in f for f in cut.inputFiles())
