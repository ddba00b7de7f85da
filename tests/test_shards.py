from linkmill.operators.shards import shard_ids


def test_shards(spark):
    rows = [("big", f"{i:04d}") for i in range(950)] + [("small", "x"), (None, "y"), (None, "z")]
    df = spark.createDataFrame(rows, "country string, id string").repartition(5)
    got = {(r.country, r.id): r.shard for r in shard_ids(df, "country", "id", 100).collect()}
    assert got == {(c, i): int(i) // 100 if c == "big" else 0 for c, i in rows}
    assert shard_ids(df.limit(0), "country", "id", 100).count() == 0
