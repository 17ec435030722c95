from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from eddyline import schemas
from eddyline.functions.time import floor_div, to_micros
from eddyline.sources import parsers
from eddyline.sources.lines import read_lines


def lines(spark, *texts):
    return spark.createDataFrame([(text,) for text in texts], "value string")


def rows(frame):
    return sorted(tuple(row) for row in frame.collect())


def kinds(schema):
    return [(field.name, field.dataType) for field in schema.fields]


def test_durations():
    assert to_micros("15 minutes") == to_micros(timedelta(minutes=15)) == 900_000_000
    assert to_micros("1 millisecond") == 1000
    with pytest.raises(ValueError):
        to_micros("soon")


def test_floor_div_rounds_down_before_the_epoch(spark):
    frame = spark.createDataFrame([(-1,), (-10,), (-11,), (0,), (9,), (10,)], "n long")
    assert [row[0] for row in frame.select(floor_div(F.col("n"), 10)).collect()] == [-1, -1, -2, 0, 0, 1]


def test_behavior_fields_are_not_trimmed(spark):
    parsed = parsers.parse_behavior(lines(spark, "1,2,3,pv,1511658000", " 1,2,3,pv,1511658000", "1,2,3,pv,x", "1,2"))
    good = parsers.accepted(parsed)
    assert kinds(good.schema) == kinds(schemas.USER_BEHAVIOR)
    assert rows(good) == [(1, 2, 3, "pv", datetime(2017, 11, 26, 1, 0))]
    assert len(rows(parsers.quarantined(parsed))) == 3


def test_login_fields_are_trimmed(spark):
    parsed = parsers.parse_login(lines(spark, "7 , 1.2.3.4,\tfail , 100 ", "x,1.2.3.4,fail,100", "7,1.2.3.4,fail"))
    good = parsers.accepted(parsed)
    assert kinds(good.schema) == kinds(schemas.LOGIN_EVENT)
    assert rows(good) == [(7, "1.2.3.4", "fail", datetime(1970, 1, 1, 0, 1, 40))]
    assert len(rows(parsers.quarantined(parsed))) == 2


def test_order_keeps_the_empty_transaction(spark):
    parsed = parsers.accepted(parsers.parse_order(lines(spark, "1,create,,5", "1,pay, t1 ,6", "1,pay,t2,")))
    assert kinds(parsed.schema) == kinds(schemas.ORDER_EVENT)
    assert [row[:3] for row in rows(parsed)] == [(1, "create", ""), (1, "pay", "t1")]
    assert [row[2] for row in rows(parsers.drop_empty_key(parsed))] == ["t1"]


def test_receipt_time_is_not_trimmed(spark):
    parsed = parsers.parse_receipt(lines(spark, " t1 , wechat ,5", "t2,alipay, 5"))
    assert kinds(parsers.accepted(parsed).schema) == kinds(schemas.RECEIPT_EVENT)
    assert [row[0] for row in rows(parsers.accepted(parsed))] == ["t1"]
    assert rows(parsers.quarantined(parsed)) == [("t2,alipay, 5",)]


def test_access_log_years_of_two_and_four_digits(spark):
    parsed = parsers.parse_access(lines(
        spark,
        "1.1.1.1 u - 17/05/2015:10:05:03 +0000 GET /a",
        "1.1.1.1 u - 17/05/15:10:05:03 +0000 GET /b extra",
        "1.1.1.1 u - 7/5/2015:1:05:03 +0000 GET /c",
        "1.1.1.1 u - 2015-05-17 +0000 GET /d",
        "1.1.1.1 u - 17/05/2015:10:05:03 +0000 GET",
    ))
    good = parsers.accepted(parsed)
    assert kinds(good.schema) == kinds(schemas.ACCESS_LOG)
    assert [(row[4], row[2]) for row in sorted(good.collect(), key=lambda row: row.url)] == [
        ("/a", datetime(2015, 5, 17, 10, 5, 3)),
        ("/b", datetime(2015, 5, 17, 10, 5, 3)),
        ("/c", datetime(2015, 5, 7, 1, 5, 3)),
    ]
    assert len(rows(parsers.quarantined(parsed))) == 2


def test_traffic_time_is_dropped_but_a_bad_number_is_malformed(spark):
    parsed = parsers.parse_traffic(lines(
        spark,
        "v\tCN\tM\t2020-01-01 00:00:01\t1.1\td1\t10\t",
        "v\tCN\tM\tyesterday\t1.1\td1\t10\t",
        "v\tCN\tM\t1970-01-01 00:00:00\t1.1\td2\t7",
        "v\tCN\tM\t2020-01-01 00:00:01\t1.1\td1\tten\t",
        "v\tCN\tM\t2020-01-01 00:00:01\t1.1\td1\t\t",
    ))
    good = parsers.accepted(parsed)
    assert kinds(good.schema) == kinds(schemas.TRAFFIC_LOG)
    assert good.count() == 3
    assert [row[2:] for row in rows(parsers.drop_untimed(good))] == [("d2", 7), ("d1", 10)]
    assert len(rows(parsers.quarantined(parsed))) == 2


def test_numbers_beyond_the_type_are_malformed(spark):
    parsed = parsers.parse_behavior(lines(spark, f"{2**63},2,3,pv,5", f"1,2,{2**31},pv,5"))
    assert parsers.accepted(parsed).count() == 0


def test_strict_fails_on_the_first_bad_line(spark):
    parsed = parsers.parse_login(lines(spark, "1,ip,fail,5", "bad"))
    with pytest.raises(PySparkException, match="malformed line: bad"):
        parsers.strict(parsed).collect()
    whole = parsers.parse_login(lines(spark, "1,ip,fail,5"))
    assert parsers.strict(whole).collect() == parsers.accepted(whole).collect()


def test_positions_follow_the_file(spark, tmp_path):
    texts = [f"{number},ip,fail,5" for number in range(2000)]
    (tmp_path / "log.csv").write_text("\n".join(texts))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        read = parsers.accepted(parsers.parse_login(read_lines(spark, str(tmp_path), numbered=True)))
        assert read.rdd.getNumPartitions() > 1
        assert [row.user_id for row in read.orderBy("seq").collect()] == list(range(2000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_years_of_two_digits(spark):
    rows = spark.createDataFrame([(f"ip u - 17/05/{year}:10:05:03 +0000 GET /x",) for year in ("99", "15")], "value string")
    read = {row.event_time.year for row in parsers.parse_access(rows).collect()}
    assert read == {1999, 2015}
    assert parsers.parse_access(rows, pivot=100).filter("year(event_time) = 2099").count() == 1
