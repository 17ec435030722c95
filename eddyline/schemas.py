"""Record types of the event logs, as Spark schemas."""

from __future__ import annotations

from pyspark.sql.types import (
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind()) for name, kind in fields.items()])


USER_BEHAVIOR = _struct(
    user_id=LongType, item_id=LongType, category_id=IntegerType,
    behavior=StringType, event_time=TimestampType,
)
ITEM_VIEW_COUNT = _struct(item_id=LongType, window_end=TimestampType, count=LongType)
ACCESS_LOG = _struct(
    ip=StringType, user_id=StringType, event_time=TimestampType,
    method=StringType, url=StringType,
)
URL_VIEW_COUNT = _struct(url=StringType, window_end=TimestampType, count=LongType)
LOGIN_EVENT = _struct(
    user_id=LongType, ip=StringType, event_type=StringType, event_time=TimestampType,
)
LOGIN_WARNING = _struct(
    user_id=LongType, first_fail_time=TimestampType, last_fail_time=TimestampType,
    warning_msg=StringType,
)
ORDER_EVENT = _struct(
    order_id=LongType, event_type=StringType, tx_id=StringType, event_time=TimestampType,
)
ORDER_RESULT = _struct(order_id=LongType, tag=StringType, result_msg=StringType)
RECEIPT_EVENT = _struct(tx_id=StringType, pay_channel=StringType, event_time=TimestampType)
TRAFFIC_LOG = _struct(
    event_time=TimestampType, ip=StringType, domain=StringType, traffic=LongType,
)
TRAFFIC_TOTAL = _struct(
    window_end=TimestampType, time_label=StringType, domain=StringType, traffic=LongType,
)
STUDENT = _struct(id=IntegerType, name=StringType, price=LongType)
