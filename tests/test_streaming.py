"""A saved model scores a streaming DataFrame the same way as a batch one."""

from __future__ import annotations

from conftest import SF001
from pyspark.sql import functions as F

from linclass.operators.fit import fit_pipeline, logistic_pipeline
from linclass.operators.score import score
from linclass.sources.models import load_model, save_model


def test_saved_model_scores_stream(spark, workdir):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    data = li.select(
        "l_orderkey", "l_linenumber", (F.col("l_returnflag") == "R").cast("double").alias("label"), "l_quantity", "l_tax"
    )
    model = fit_pipeline(logistic_pipeline(["l_quantity", "l_tax"], reg=0.01), data)
    path = save_model(model, f"{workdir}/model", spark)
    loaded = load_model(spark, path)

    stream = spark.readStream.schema(data.schema).parquet(_write(data, f"{workdir}/in"))
    q = (
        score(loaded, stream)
        .select("l_orderkey", "l_linenumber", "margin", "prediction")
        .writeStream.format("memory")
        .queryName("scored_stream")
        .option("checkpointLocation", f"{workdir}/ckpt")
        .start()
    )
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    streamed = spark.table("scored_stream")
    batch = score(model, data).select("l_orderkey", "l_linenumber", "margin", "prediction")
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch).count() == 0


def _write(df, path):
    df.write.mode("overwrite").parquet(path)
    return path
