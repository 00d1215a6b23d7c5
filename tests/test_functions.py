"""Scalar functions."""

import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidematch import schemas
from tidematch.functions import geo, jsontext, sqludf, timetext
from tidematch.sources.kafka import decode_topic


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_days_between(spark):
    got = one(
        spark,
        timetext.days_between(F.lit("20210601"), F.lit("20230601")),
        timetext.days_between(F.lit("20230601"), F.lit("20210601")),
        timetext.days_between(F.lit("2021-06"), F.lit("20230601")),
    )
    assert got == (730, -730, None)


@pytest.mark.parametrize(
    "start,end,parts",
    [
        ("2014-05-23", "2018-03-12", (3, 9, 17)),
        ("2022-01-31", "2022-03-01", (0, 1, 1)),
        ("2020-02-29", "2021-02-28", (0, 11, 30)),
        ("2022-03-05", "2022-03-01", (0, 0, -4)),
        ("2022-03-05", "2021-01-10", (-1, -1, -26)),
        ("2022-03-05", "2022-03-05", (0, 0, 0)),
    ],
)
def test_period_between(spark, start, end, parts):
    day = lambda text: F.lit(text).cast("date")
    assert tuple(one(spark, timetext.period_between(day(start), day(end)))[0]) == parts


def test_period_until_today(spark):
    assert tuple(one(spark, timetext.period_until_today(F.current_date()))[0]) == (0, 0, 0)


def test_time_text(spark):
    time = timetext.parse_time(F.lit("2021-06-01 14:07:02.100"), timetext.MILLIS)
    got = one(
        spark,
        timetext.format_time(time, timetext.MILLIS),
        timetext.format_time(time, timetext.COMPACT_SECONDS),
        timetext.parse_time(F.lit("yesterday")),
        timetext.window_label(time, time),
        timetext.minute_parity_of_text(F.lit("2021-06-01 14:07:02")),
        timetext.minute_parity_of_text(F.lit("2021-06-01 14:08:02")),
        F.length(timetext.current_minute()),
        F.length(timetext.now_text()),
        timetext.current_period().isin("0", "1"),
    )
    assert got == (
        "2021-06-01 14:07:02.100", "20210601140702", None,
        "start: 2021-06-01 14:07:02 end:2021-06-01 14:07:02", "1", "0", 2, 19, True,
    )


def test_sql_functions(spark):
    session = spark.newSession()
    sqludf.register(session)
    row = session.sql(
        "SELECT lat('2022-02-10 10:11:00') a, lng('2022-02-10 10:12:00') b, lat('x') c, "
        "length(curMinute('')) d, udfTimePeriod('any') IN ('0', '1') e"
    ).first()
    assert tuple(row) == ("1", "0", None, 2, True)
    named = spark.newSession()
    sqludf.register(named, sqludf.SQL_NAME_FUNCTIONS)
    assert tuple(named.sql("SELECT lat(), lng()").first()) == ("lat", "lng")


def test_haversine_is_whole_metres(spark):
    spot = [F.lit(v) for v in (15.1012, 35.1012, 15.1012, 35.101201)]
    assert one(spark, geo.haversine_m(*spot)) == (0.0,)
    far = [F.lit(v) for v in (0.0, 0.0, 0.0, 1.0)]
    assert one(spark, geo.haversine_m(*far)) == (111320.0,)
    assert one(spark, geo.within_range(F.lit(10.0), F.lit("10")),
               geo.within_range(F.lit(10.0), F.lit("10.5")),
               geo.within_range(F.lit(10.0), F.lit("near"))) == (False, True, None)


def test_bad_numbers_are_null(spark):
    got = one(spark, *[geo.as_double(F.lit(t)) for t in ("1.5", "x", "", "-3e2")])
    assert got == (1.5, None, None, -300.0)


PERSON = T.StructType([T.StructField("name", T.StringType()), T.StructField("age", T.IntegerType())])


@pytest.mark.parametrize(
    "text,record",
    [
        ('{"name":"Fred","age":35,"more":[1]}', ("Fred", 35)),
        ('{"name":5}', ("5", None)),
        ("{}", (None, None)),
        ("  ", None),
        ("", None),
        (None, None),
        ("{bad", None),
        ('{"age":"old"}', None),
    ],
)
def test_parse_record(spark, text, record):
    lit = F.lit(text).cast("string")
    got = one(spark, jsontext.parse_record(lit, PERSON))[0]
    assert (None if got is None else tuple(got)) == record


def test_to_text(spark):
    record = F.struct(F.lit("a").alias("x"), F.lit(None).cast("int").alias("y"))
    nothing = F.lit(None).cast("struct<x:string>")
    assert one(spark, jsontext.to_text(record), jsontext.to_text(nothing)) == (
        '{"x":"a","y":null}', ""
    )
    assert "\n" in one(spark, jsontext.to_text(record, pretty=True))[0]


def test_map_list_and_copy(spark):
    person = jsontext.parse_record(F.lit('{"name":"Fred","age":35}'), PERSON)
    got = one(
        spark,
        F.to_json(jsontext.parse_map(F.lit('{"a":1,"b":"x"}'))),
        jsontext.parse_map(F.lit(" ")),
        jsontext.parse_list(F.lit('["a","b"]')),
        jsontext.copy_as(person, T.StructType([T.StructField("name", T.StringType())]))["name"],
    )
    assert got == ('{"a":1,"b":"x"}', None, ["a", "b"], "Fred")


def test_envelopes(spark):
    assert one(spark, jsontext.error_envelope("late"), jsontext.success_envelope()) == (
        '{"message":"late","value":null,"success":false,"msgCode":"999999","resultMap":null}',
        '{"message":"处理成功","value":null,"success":true,"msgCode":"000000","resultMap":null}',
    )


def test_empty_and_blank(spark):
    texts = [F.lit(t).cast("string") for t in ("a", " ", "", None)]
    assert one(spark, *[jsontext.not_empty(t) for t in texts]) == (True, True, False, False)
    assert one(spark, *[jsontext.is_blank(t) for t in texts]) == (False, True, True, True)


def test_topic_records_are_in_their_zone(spark):
    lines = spark.createDataFrame(
        [('{"msgId":"1","tradeId":"t","createTime":"2022-02-10 08:00:00","extra":1}',),
         ("nothing",), ("",)],
        "value string",
    )
    got = decode_topic(lines)
    assert got.columns == list(schemas.TOPIC_FIELDS.values())
    assert [r["text"] for r in got.select(
        timetext.format_time(F.col("create_time")).alias("text")).collect()] == [
        "2022-02-10 00:00:00"
    ]
    assert got.first()["update_time"] is None


def test_processing_time_is_now(spark):
    from tidematch.operators.shape import with_processing_time

    stamped = with_processing_time(spark.range(2)).collect()
    assert stamped[0]["proctime"] == stamped[1]["proctime"]
    assert isinstance(stamped[0]["proctime"], datetime.datetime)
