import json

import pytest
from pyspark.sql import functions as F

from viewtally import schemas as S
from viewtally.functions import parse as P


def msg(spark, rows):
    return spark.createDataFrame(rows, S.MESSAGE)


def payload(**kw):
    base = dict(referrer="r", product="p", metric="m", location="l", video="v1",
                uuid="u-1", url="x", timestamp="1")
    base.update(kw)
    return json.dumps({k: v for k, v in base.items() if v is not None})


def test_uid_fallback(spark):
    rows = [("1000", payload(), "p-pageview", 0, 0),
            ("1001", payload(viewer=""), "p-pageview", 0, 1),
            ("1002", payload(viewer="42"), "p-pageview", 0, 2)]
    out = P.valid_events(msg(spark, rows)).orderBy("offset").select("uid").collect()
    assert [r.uid for r in out] == ["u-1", "u-1", "42"]


def test_click_and_order_uid_is_viewer(spark):
    rows = [("1", payload(viewer=""), "p-click", 0, 0),
            ("2", payload(viewer="7", order="o-1"), "p-order", 0, 1)]
    out = P.valid_events(msg(spark, rows)).orderBy("offset").select("uid").collect()
    assert [r.uid for r in out] == ["", "7"]


def test_rejects(spark):
    rows = [("1", "bad", "p-pageview", 0, 0),
            ("2", payload(order="o-1"), "p-order", 0, 1),           # order without viewer
            ("x", payload(), "p-pageview", 0, 2),                    # key not a number
            ("3", payload(video=None), "p-click", 0, 3),             # missing required field
            ("4", payload(), "p-pageview", 0, 4)]
    out = {r.offset: r.reject_reason for r in P.parse_messages(msg(spark, rows)).collect()}
    assert out == {0: "bad json", 1: "missing viewer", 2: "bad key", 3: "missing video", 4: None}


def test_strict_raises(spark):
    rows = [("1", payload(), "p-pageview", 0, 0), ("2", "bad", "p-pageview", 0, 1)]
    with pytest.raises(Exception):
        P.parse_messages(msg(spark, rows), strict=True).collect()
    with pytest.raises(Exception):
        P.parse_messages(msg(spark, [("2", payload(order="o"), "p-order", 0, 0)]), strict=True).collect()


def test_log_rows_and_metric_from_topic(spark):
    rows = [("1704067207179", payload(), "prod-pageview", 2, 5)]
    r = P.log_rows(msg(spark, rows), with_id=True).first()
    assert r.metric == "pageview" and r.msg_id == "prod-pageview-2-5"
    assert str(r.log_date) == "2024-01-01 00:00:07.179000"
    assert P.topics_for("prod") == ["prod-pageview", "prod-click", "prod-order"]


def test_json_valid(spark):
    df = spark.createDataFrame([('{"a":1}',), ("{",)], "data string")
    assert [r.ok for r in df.select(P.json_valid().alias("ok")).collect()] == [True, False]
