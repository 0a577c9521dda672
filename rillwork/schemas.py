"""Record types, declared in full: nothing here is ever inferred from data."""

from pyspark.sql import types as T


def _record(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


_S, _L, _I, _TS = T.StringType(), T.LongType(), T.IntegerType(), T.TimestampNTZType()

# ts in epoch seconds unless stated; vc is the measured height.
WATER_SENSOR = _record(id=_S, ts=_L, vc=_I)
USER_BEHAVIOR = _record(user_id=_L, item_id=_L, category_id=_I, behavior=_S, ts=_L)
MARKETING_BEHAVIOR = _record(user_id=_L, behavior=_S, channel=_S, ts=_L)  # ts in ms
AD_CLICK = _record(user_id=_L, ad_id=_L, province=_S, city=_S, ts=_L)
ORDER_EVENT = _record(order_id=_L, event_type=_S, tx_id=_S, ts=_L)  # tx_id empty on create
RECEIPT = _record(tx_id=_S, pay_channel=_S, ts=_L)
LOGIN_EVENT = _record(user_id=_L, ip=_S, event_type=_S, ts=_L)
WEB_LOG = _record(ip=_S, user_id=_S, ts=_TS, method=_S, url=_S)

# The test tables' event log.
EVENT = T.StructType([
    T.StructField("event_id", _L), T.StructField("ts", _TS), T.StructField("user_id", _L),
    T.StructField("event_type", _S), T.StructField("value", T.DoubleType()), T.StructField("props", _S),
])
