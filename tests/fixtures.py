"""The sample rows the job was first tried with."""

from tidematch import schemas

# cert_nbr, lat, lng, lat_night, lng_night
_POSITIONS = [
    ("11111", "12.1012", "32.1012", "12.1012", "32.1012"),
    ("22222", "11.1012", "33.1012", "11.1012", "33.1012"),
    ("33333", "14.1012", "44.1012", "16.1012", "48.1012"),
    ("44444", "15.1012", "35.1012", "17.1012", "38.1012"),
    ("55555", "15.1012", "35.101201", "17.1012", "38.101201"),
    ("66666", "15.1012", "35.101201", "17.1012", "38.101201"),
    ("77777", "15.1012", "35.101201", "17.1012", "38.101201"),
]

REQUEST = (
    "coupon_id string, store_range string, store_longitude string, store_latitude string, "
    "user_num string, message_type string, store_id string, unique_req_id string"
)


def user_location(spark):
    rows = [
        (str(i + 1), nbr, lat, lng, None, f"destination{i + 1}")
        for i, (nbr, lat, lng, _, _) in enumerate(_POSITIONS[:6])
    ]
    return spark.createDataFrame(rows, schemas.USER_LOCATION)


def user_location_info(spark, users=6):
    rows = [
        ("1", nbr, lat, lng, lat_night, lng_night, None, f"destination{i + 1}")
        for i, (nbr, lat, lng, lat_night, lng_night) in enumerate(_POSITIONS[:users])
    ]
    return spark.createDataFrame(rows, schemas.USER_LOCATION_INFO)


def group_count(spark):
    keys = ["1"] * 6 + ["2", "3", "4", "5"]
    return spark.createDataFrame([(a, f"b{i}") for i, a in enumerate(keys)], schemas.GROUP_COUNT)


def request(lat, lng, store_range="500", req="R1", kind="01"):
    return ("C1", store_range, str(lng), str(lat), "10", kind, "S1", req)


def requests(spark, *rows):
    return spark.createDataFrame(list(rows), REQUEST)


def topic(spark, rows):
    """Rows of (seq, trade_id, msg_id, status_code, second)."""
    schema = "seq long, trade_id string, msg_id string, status_code string, second double"
    return spark.createDataFrame(rows, schema).selectExpr(
        "seq", "trade_id", "msg_id", "status_code",
        "timestamp_micros(cast(1700000000000000 + second * 1000000 as bigint)) as create_time",
    )
