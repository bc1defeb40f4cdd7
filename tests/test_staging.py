"""Where intermediate tables go."""

from types import SimpleNamespace

import pytest

from clickfacts.session import CODEGEN_SETTINGS, RESULT_SETTINGS, SKEW_SETTINGS
from clickfacts.sources import staging


def fake(master, setting=None):
    conf = SimpleNamespace(get=lambda key, default: setting or default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId="app"))


def test_shared_root():
    assert staging.shared_root(fake("yarn", "s3a://b/tmp/")) == "s3a://b/tmp"
    assert staging.shared_root(fake("local[2]")) == staging.shared_root(fake("local[2]"))
    with pytest.raises(RuntimeError):
        staging.shared_root(fake("yarn"))
    with pytest.raises(RuntimeError):
        staging.shared_root(fake("local-cluster[3,2,1000]"))


def test_stage(spark):
    df = spark.range(10).selectExpr("id", "array(struct(id as a)) as s")
    staged = staging.stage(df, "t")
    assert sorted(staged.collect()) == sorted(df.collect())
    assert staging.fresh_path(spark, "t") != staging.fresh_path(spark, "t")


def test_discard(spark, tmp_path):
    path = str(tmp_path / "t")
    staging.stage(spark.range(10), "t", path)
    staging.discard(spark, path)
    assert not (tmp_path / "t").exists()


def test_settings(spark):
    for key, value in {**RESULT_SETTINGS, **SKEW_SETTINGS, **CODEGEN_SETTINGS}.items():
        assert spark.conf.get(key) == value
