from pyspark.sql import functions as F

from mergetide.streaming import incremental


def test_claims_are_made_once(spark, tmp_path):
    rows = [("s", str(k % 7), f"n{k}") for k in range(30)]
    df = spark.createDataFrame(rows, "source_id string, native_identity string, name string")
    for part in range(3):
        df.where(F.substring("name", 2, 9).cast("int") % 3 == part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    got = []
    stream = incremental.read_stream(spark, str(tmp_path / "in"), df, 1)
    for _ in range(2):
        q = incremental.claim_batches(stream, str(tmp_path / "claimed"), str(tmp_path / "cp"), lambda b, n: got.extend(r.key for r in b.collect()))
        q.awaitTermination()
    assert sorted(got) == sorted({f"s::{k}" for k in range(7)})


def test_counts_over_a_stream(spark, tmp_path):
    df = spark.sql("select timestamp'2025-01-01 00:00:00' + make_interval(0,0,0,0,0,cast(id as int)) as at, concat('s', id % 2) as source_id, cast(id as string) as native_identity from range(120)")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    s = incremental.read_stream(spark, str(tmp_path / "in"), df)
    q = incremental.windowed_counts(s, "at", "source_id", "1 hour", "1 hour").writeStream.outputMode("complete").format("memory").queryName("counts").option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert {(r.start.hour, r.source_id, r.n) for r in spark.table("counts").collect()} == {(0, "s0", 30), (0, "s1", 30), (1, "s0", 30), (1, "s1", 30)}
    q = incremental.first_deliveries(s.union(s), "at", "1 hour").writeStream.format("memory").queryName("firsts").option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("firsts").count() == 120
