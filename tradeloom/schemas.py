"""Declared schemas of the raw feeds and of the live order payload."""

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
_TS = T.TimestampType()

MONEY = T.DecimalType(18, 2)
DISCOUNT = T.DecimalType(5, 4)

# Raw files carry text; the silver layer does the typing, so that bad values can be
# reported and not only lost.
USERS_RAW = _struct(user_id=_S, name=_S, email=_S, city=_S, state=_S, signup_date=_S,
                    preferred_device=_S)
PRODUCTS_RAW = _struct(product_id=_S, product_name=_S, category=_S, sub_category=_S, brand=_S,
                       list_price=_S)
ORDERS_RAW = _struct(order_id=_S, session_id=_S, user_id=_S, product_id=_S, order_timestamp=_S,
                     quantity=_S, unit_price=_S, discount_pct=_S, payment_method=_S,
                     order_status=_S, return_timestamp=_S)
CLICKS_RAW = _struct(event_id=_S, session_id=_S, user_id=_S, device_type=_S, event_type=_S,
                     event_timestamp=_S, product_id=_S, payment_status=_S)
EMPLOYEES = _struct(emp_id=_I, name=_S, department=_S, salary=_D, city=_S, join_date=T.DateType())

# Payload of one live order (JSON text in the message value).
LIVE_ORDER = _struct(order_id=_S, user_id=_S, product_id=_S, quantity=_I, unit_price=_D,
                     payment_method=_S, payment_status=_S, order_timestamp=_S)
# Columns of a message stream, whether it comes from Kafka or from files.
ENVELOPE = _struct(key=T.BinaryType(), value=T.BinaryType(), timestamp=_TS)
