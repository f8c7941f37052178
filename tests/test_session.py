"""Scratch folder and stored tables."""

from types import SimpleNamespace

import pytest

from resight import session


def test_no_local_scratch_on_a_cluster():
    conf = SimpleNamespace(get=lambda key, default=None: default)
    cluster = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_dir(cluster)


def test_stored_notices_changed_input(spark, tmp_path):
    source = str(tmp_path / "t.parquet")

    def build():
        return spark.read.parquet(source)

    def rows():
        return session.stored(spark, "t", str(tmp_path), build).count()

    spark.range(3).write.parquet(source)
    assert rows() == rows() == 3
    spark.range(5).write.mode("overwrite").parquet(source)
    assert rows() == 5
