import math

from tillstream import session


def test_shuffles_grow_with_the_input(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(100_000).write.parquet(path)
    rows = spark.read.parquet(path)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert session.size_shuffles(spark, rows) == int(before)
        wanted = session.size_shuffles(spark, rows, rows, per_partition=10_000)
        assert wanted > int(before)
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(wanted)
        many = session.size_shuffles(spark, rows, per_partition=1)
        assert many == math.ceil(session.planned_bytes(rows)) > 100_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_pin_sets_the_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    assert session.pin(spark).conf.get("spark.sql.session.timeZone") == "UTC"
