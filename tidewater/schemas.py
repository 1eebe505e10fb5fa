"""Record types of the input feeds."""

from pyspark.sql import types as T


_TYPES = {"string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType()}


def _of(fields: str) -> T.StructType:
    pairs = [f.split() for f in fields.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Field names of the feeds are fixed values: input files and messages carry them.
CLICK = _of("user string, url string, ts bigint")
LOGIN_EVENT = _of("user_id string, ip string, event_type string, ts bigint")
ORDER_EVENT = _of("user_id string, order_id string, event_type string, ts bigint")
USER_BEHAVIOR = _of("user_id bigint, item_id bigint, category_id int, behavior string, ts bigint")
AD_CLICK = _of("user_id string, ad_id string, province string, city string, ts bigint")
LOGIN_RECORD = _of("user_id string, ip string, status string, ts bigint")
ORDER_LOG = _of("order_id string, action string, tx_id string, ts bigint")
RECEIPT_LOG = _of("tx_id string, channel string, ts bigint")
PERSON_JSON = _of(
    "id string, name string, sex string, birthday string, address string, amount string, education string, "
    "job string, phone string, creditcard string"
)
PERSON_RENAMES = {"phone": "idphone"}
