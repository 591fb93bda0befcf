from pyspark.sql import functions as F

from lakemart.functions import epoch_ms_to_ntz, epoch_ms_to_text, epoch_ms_whole_seconds, ntz_to_epoch_ms, time_parts


def _parts(spark, ms, base):
    df = spark.createDataFrame([(ms,)], "ts long")
    return df.select(*time_parts(epoch_ms_to_ntz("ts"), base)).first().asDict()


def test_golden_row_all_bases(spark):
    # 1543449657796 ms = 2018-11-29 00:00:57.796 UTC, a Thursday
    for base, wd in (("mon0", 3), ("sun0", 4), ("sun1", 5)):
        assert _parts(spark, 1543449657796, base) == {"hour": 0, "day": 29, "week": 48, "month": 11,
                                                      "year": 2018, "weekday": wd}


def test_iso_week_edges(spark):
    assert _parts(spark, 1546214400000, "mon0")["week"] == 1    # 2018-12-31
    assert _parts(spark, 1609459200000, "mon0")["week"] == 53   # 2021-01-01


def test_conversions_round_trip(spark):
    df = spark.createDataFrame([(1543449657796,)], "ts long")
    r = df.select(epoch_ms_to_ntz("ts").alias("t"), epoch_ms_whole_seconds("ts").alias("s"),
                  epoch_ms_to_text("ts").alias("txt")).select(
        "t", "s", "txt", ntz_to_epoch_ms("t").alias("back")).first()
    assert str(r.t) == "2018-11-29 00:00:57.796000"
    assert str(r.s) == "2018-11-29 00:00:57"
    assert r.txt == "2018-11-29 00:00:57"
    assert r.back == 1543449657796


def test_independent_of_session_time_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Pacific/Kiritimati")
        assert _parts(spark, 1543449657796, "mon0")["hour"] == 0
        df = spark.createDataFrame([(1543449657796,)], "ts long")
        assert df.select(epoch_ms_to_text("ts")).first()[0] == "2018-11-29 00:00:57"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_bad_weekday_base(spark):
    import pytest
    with pytest.raises(ValueError):
        time_parts(F.col("x"), "tue0")


def test_epoch_round_trip_inside_a_dst_gap(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        # 02:30 on 2024-03-10 does not exist in Los Angeles; 01:30 on 2024-11-03 exists twice
        df = spark.createDataFrame([(1710037800000,), (1730597400000,), (-1,)], "ms long")
        back = df.select("ms", ntz_to_epoch_ms(epoch_ms_to_ntz("ms")).alias("b")).collect()
        assert all(r.ms == r.b for r in back)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
