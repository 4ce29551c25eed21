"""Saved models: versions, commit records, failures on the way."""

from __future__ import annotations

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from linclass.operators.fit import fit_pipeline, logistic_pipeline
from linclass.operators.linear import LinearModel
from linclass.sources.models import load_model, model_versions, save_model


def pipeline(spark):
    rows = spark.range(100).select((F.col("id") % 2).cast("double").alias("label"), (F.col("id") % 5).cast("double").alias("x"))
    return fit_pipeline(logistic_pipeline(["x"]), rows, persist=False)


def test_the_newest_version_is_loaded_whatever_its_kind(spark, workdir):
    path = f"{workdir}/m"
    for model in (LinearModel(["x"], [1.0]), pipeline(spark), LinearModel(["x", "y"], [2.0, 3.0])):
        assert save_model(model, path, spark) == path
        loaded = load_model(spark, path)
        assert type(loaded) is type(model)
    assert loaded.weights == [2.0, 3.0]
    log = model_versions(spark, path).orderBy("number").collect()
    assert [r.number for r in log] == [1, 2, 3]
    assert load_model(spark, path, log[0].version).weights == [1.0] and isinstance(load_model(spark, path + "/", log[1].version), PipelineModel)


@pytest.mark.parametrize("fails_at", ["model", "commit"])
def test_a_save_that_fails_leaves_the_old_model(spark, workdir, monkeypatch, fails_at):
    path = f"{workdir}/m"
    save_model(LinearModel(["x"], [1.0]), path, spark)

    def broken(self, spark, at):
        if fails_at == "commit":
            kept(self, spark, at)  # all of the version is there, but nothing names it
        raise OSError("disk full")

    kept = LinearModel.save
    monkeypatch.setattr(LinearModel, "save", broken)
    with pytest.raises(OSError, match="disk full"):
        save_model(LinearModel(["x"], [9.0]), path, spark)
    monkeypatch.undo()
    assert load_model(spark, path).weights == [1.0] and model_versions(spark, path).count() == 1
    save_model(LinearModel(["x"], [5.0]), path, spark)
    assert load_model(spark, path).weights == [5.0]


def test_the_plain_layout_and_missing_models(spark, workdir):
    LinearModel(["x"], [4.0]).save(spark, f"{workdir}/plain")
    assert load_model(spark, f"{workdir}/plain").weights == [4.0]
    pipeline(spark).write().save(f"{workdir}/ml")
    assert isinstance(load_model(spark, f"{workdir}/ml"), PipelineModel)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        load_model(spark, f"{workdir}/none")
    with pytest.raises(TypeError):
        save_model("text", f"{workdir}/none", spark)
