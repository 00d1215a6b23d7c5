"""Record types. Numbers travel as text in messages and are cast in queries."""

from __future__ import annotations

from pyspark.sql import types as T


def _text(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


# Message field names are fixed values: they are the JSON keys on the topics.
COUPON_REQUEST_FIELDS = {
    "COUPON_ID": "coupon_id",
    "STORE_RANGE": "store_range",
    "STORE_LONGITUDE": "store_longitude",
    "STORE_LATITUDE": "store_latitude",
    "USER_NUM": "user_num",
    "MESSAGE_TYPE": "message_type",
    "STORE_ID": "store_id",
    "UNIQUE_REQ_ID": "unique_req_id",
}
COUPON_RESULT_FIELDS = {
    "COUPON_ID": "coupon_id",
    "MESSAGE_TYPE": "message_type",
    "COUPON_SEND_NUM": "coupon_send_num",
    "SERIAL_NO": "serial_no",
    "ID_TYPE": "id_type",
    "ID_NUMBER": "id_number",
    "STORE_ID": "store_id",
    "STORE_RANGE": "store_range",
    "UNIQUE_REQ_ID": "unique_req_id",
}
TOPIC_FIELDS = {
    "msgId": "msg_id",
    "tradeId": "trade_id",
    "statusCode": "status_code",
    "createTime": "create_time",
    "updateTime": "update_time",
}

REQUEST_KEYS = ["coupon_id", "store_id", "store_range", "user_num", "unique_req_id"]

COUPON_REQUEST_JSON = T.StructType(_text(*COUPON_REQUEST_FIELDS))
TOPIC_JSON = T.StructType(
    _text("msgId", "tradeId", "statusCode")
    + [
        T.StructField("createTime", T.TimestampType()),
        T.StructField("updateTime", T.TimestampType()),
    ]
)
TOPIC_TIME_OPTIONS = {"timestampFormat": "yyyy-MM-dd HH:mm:ss", "timeZone": "GMT+8"}

PEOPLE = T.StructType(
    [T.StructField("id", T.IntegerType())] + _text("name", "destination")
)
PEOPLE_DAY = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("work_day", T.DateType()),
        T.StructField("destination", T.StringType()),
    ]
)
USER_LOCATION = T.StructType(
    _text("cert_type", "cert_nbr", "lat", "lng")
    + [T.StructField("work_day", T.DateType())]
    + _text("destination")
)
USER_LOCATION_INFO = T.StructType(
    _text("cert_type", "cert_nbr", "lat", "lng", "lat_night", "lng_night")
    + [T.StructField("work_day", T.DateType())]
    + _text("destination")
)
GROUP_COUNT = T.StructType(_text("a", "b"))
