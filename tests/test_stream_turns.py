import random

from pyspark.sql import functions as F

from batchlens.operators.stream_turns import stream_turns
from batchlens.operators.turns import speaker_turns

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def test_three_batches_equal_the_whole(spark, tmp_path):
    rng = random.Random(9)
    schema = "file_ids bigint, segment_id bigint, start double, end double, label string"
    whole = []
    for batch in range(3):
        rows = []
        for f in (1, 2, 3, 4):
            # file 3 skips the second batch, file 4 only comes with the last
            if (f, batch) == (3, 1) or (f == 4 and batch < 2):
                continue
            for n in range(rng.randint(1, 12)):
                start = batch * 100.0 + rng.choice([n, n, n + 0.5])
                rows.append((f, batch * 100 + n, start, start + rng.random(), rng.choice(["a", "a", "b", None])))
        rng.shuffle(rows)
        whole += rows
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    try:
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        out = str(tmp_path / "out")

        def keep(df, number):
            df.withColumn("batch", F.lit(number)).write.mode("append").parquet(out)

        query = (
            stream_turns(stream).writeStream.outputMode("update").foreachBatch(keep)
            .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        )
        assert query.awaitTermination(120)
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    rows = spark.read.parquet(out)
    assert rows.select("batch").distinct().count() == 3
    latest = rows.groupBy("file_ids", "turn").agg(F.max_by(F.struct("speaker", "start", "end"), "batch").alias("t"))
    got = latest.select("file_ids", "turn", "t.*").collect()
    expected = speaker_turns(spark.createDataFrame(whole, schema)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, map(tuple, expected)))
