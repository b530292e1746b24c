from pyspark.sql import functions as F

from conftest import ms
from viewtally.functions import time as tm


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def test_zone_label(spark):
    t = ms("2024-01-01 00:00:07.179")
    assert one(spark, tm.minute_label(F.lit(t))) == "202401010700"
    assert one(spark, tm.hour_label(F.lit(t))) == "2024010107"
    assert one(spark, tm.format_ms(F.lit(t))) == "2024-01-01 07:00:07"


def test_ms_ntz_round_trip_independent_of_session_zone(spark):
    t = ms("2024-01-05 10:11:12.345")
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Los_Angeles", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert one(spark, tm.ntz_to_ms(tm.ms_to_ntz(F.lit(t)))) == t
            assert one(spark, tm.minute_label(F.lit(t))) == "202401051711"
            assert one(spark, tm.hour_start(F.lit(t))) == ms("2024-01-05 10:00:00")
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)


def test_half_hour_zone_hour_start(spark):
    # India is UTC+5:30: its hours start at :30 UTC
    t = ms("2024-01-05 10:11:12")
    assert one(spark, tm.hour_start(F.lit(t), "Asia/Kolkata")) == ms("2024-01-05 09:30:00")


def test_minute_list_of_hour_ago(spark):
    # 12:34 local (+7) = 05:34 UTC; 5 hours back is 07:34 local
    t = ms("2024-01-01 05:34:00")
    labels = one(spark, tm.minute_list_of_hour_ago(F.lit(t), 5))
    assert len(labels) == 26
    assert labels[0] == "202401010759" and labels[-1] == "202401010734"
    t59 = ms("2024-01-01 05:59:00")
    assert one(spark, tm.minute_list_of_hour_ago(F.lit(t59), 5)) == ["202401010759"]


def test_hour_list_before(spark):
    t = ms("2024-01-01 05:34:00")
    assert one(spark, tm.hour_list_before(F.lit(t), 5)) == [
        "2024010108", "2024010109", "2024010110", "2024010111", "2024010112"]


def test_minute_list_before(spark):
    t = ms("2024-01-01 05:34:00")
    assert one(spark, tm.minute_list_before(F.lit(t), 3)) == [
        "202401011232", "202401011233", "202401011234"]


def test_bucket_key(spark):
    assert one(spark, tm.bucket_key("videoviews", F.lit("202401010700"))) == "videoviews:202401010700"


def test_fixed_offset_detection(spark):
    jan, jul = ms("2024-01-10 00:00:00"), ms("2024-07-10 00:00:00")
    assert tm.fixed_offset_ms("Asia/Ho_Chi_Minh", jan, jul) == 7 * 3_600_000
    assert tm.fixed_offset_ms("Asia/Kolkata", jan, jan + 86_400_000) == 19_800_000
    assert tm.fixed_offset_ms("Europe/Berlin", jan, jul) is None
    assert tm.fixed_offset_ms("Europe/Berlin", jan, jan + 5 * 86_400_000) == 3_600_000
    t = ms("2024-01-05 10:11:12")
    fast = one(spark, tm.hour_start(F.lit(t), "Asia/Kolkata", 19_800_000))
    assert fast == one(spark, tm.hour_start(F.lit(t), "Asia/Kolkata"))


def test_cluster_settings_scale_with_input():
    from viewtally.session import cluster_settings
    big = cluster_settings(100 << 40, 8000)
    small = cluster_settings(1 << 30, 8)
    assert int(big["spark.sql.shuffle.partitions"]) == 102400
    assert int(small["spark.sql.shuffle.partitions"]) == 24
    assert big["spark.sql.adaptive.enabled"] == "true"
