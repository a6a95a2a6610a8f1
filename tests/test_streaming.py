from pyspark.sql import functions as F

from quarry.operators import encode, trees


def test_fitted_models_score_a_stream(spark, tmp_path):
    rows = [(i, [float(i % 7), float(i % 3)], float(i % 7 > 3), float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, features array<double>, label double, v double")
    df.write.parquet(str(tmp_path / "in"))
    tree = trees.fit_tree(df, max_depth=3)
    scaler = encode.fit_scaler(df, ["v"])
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = (
        scaler.transform(tree.transform(stream))
        .writeStream.format("memory")
        .queryName("scored")
        .option("checkpointLocation", str(tmp_path / "cp"))
        .start()
    )
    q.processAllAvailable()
    q.stop()
    out = spark.sql("SELECT * FROM scored")
    assert out.count() == 60 and out.filter("prediction <> label").count() == 0
    assert abs(out.agg(F.avg("v")).first()[0]) < 1e-9
