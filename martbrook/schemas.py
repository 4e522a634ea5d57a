"""Record layouts of the warehouse, by layer."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I = T.StringType(), T.LongType(), T.IntegerType()
MONEY = T.DecimalType(16, 2)
TEXT_MAP = T.MapType(S, S)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# --- raw input -------------------------------------------------------------
COMMON = _struct(mid=S, vc=S, ch=S, ar=S, is_new=S)
PAGE = _struct(page_id=S, last_page_id=S, item=S, during_time=L)
DISPLAY = _struct(item=S, item_type=S)
APP_LOG = _struct(common=COMMON, page=PAGE, start=TEXT_MAP, displays=T.ArrayType(DISPLAY), ts=L)

CHANGE_ENVELOPE = _struct(source=_struct(db=S, table=S), op=S, before=TEXT_MAP, after=TEXT_MAP)
CHANGE = _struct(database=S, table=S, type=S, data=TEXT_MAP)
ROUTING = _struct(
    source_table=S, operate_type=S, sink_type=S, sink_table=S, sink_columns=S, sink_pk=S, sink_extend=S
)

# --- facts -----------------------------------------------------------------
ORDER_INFO = _struct(
    id=L, province_id=L, order_status=S, user_id=L,
    total_amount=MONEY, activity_reduce_amount=MONEY, coupon_reduce_amount=MONEY,
    original_total_amount=MONEY, feight_fee=MONEY,
    expire_time=S, create_time=S, operate_time=S, create_date=S, create_hour=S, create_ts=L,
)
ORDER_DETAIL = _struct(
    id=L, order_id=L, sku_id=L, order_price=MONEY, sku_num=L, sku_name=S, create_time=S,
    split_total_amount=MONEY, split_activity_amount=MONEY, split_coupon_amount=MONEY, create_ts=L,
)
PAYMENT_INFO = _struct(
    id=L, order_id=L, user_id=L, total_amount=MONEY, subject=S, payment_type=S, create_time=S, callback_time=S
)
FAVOR_INFO = _struct(sku_id=L, create_time=S)
CART_INFO = _struct(sku_id=L, create_time=S)
REFUND_INFO = _struct(order_id=L, sku_id=L, refund_amount=MONEY, create_time=S)
COMMENT_INFO = _struct(sku_id=L, appraise=S, create_time=S)

# --- wide rows -------------------------------------------------------------
ORDER_WIDE = _struct(
    detail_id=L, order_id=L, sku_id=L, order_price=MONEY, sku_num=L, sku_name=S,
    province_id=L, order_status=S, user_id=L,
    total_amount=MONEY, activity_reduce_amount=MONEY, coupon_reduce_amount=MONEY,
    original_total_amount=MONEY, feight_fee=MONEY, split_feight_fee=MONEY,
    split_activity_amount=MONEY, split_coupon_amount=MONEY, split_total_amount=MONEY,
    expire_time=S, create_time=S, operate_time=S, create_date=S, create_hour=S,
    province_name=S, province_area_code=S, province_iso_code=S, province_3166_2_code=S,
    user_age=I, user_gender=S,
    spu_id=L, tm_id=L, category3_id=L, spu_name=S, tm_name=S, category3_name=S,
    create_ts=L,  # create_time as epoch milliseconds, so that no later step parses the text again
)

# --- result tables (the order of columns is that of the store) --------------
VISITOR_STATS = ["stt", "edt", "vc", "ch", "ar", "is_new",
                 "uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum", "ts"]
PRODUCT_STATS = ["stt", "edt", "sku_id", "sku_name", "sku_price", "spu_id", "spu_name",
                 "tm_id", "tm_name", "category3_id", "category3_name",
                 "display_ct", "click_ct", "favor_ct", "cart_ct", "order_sku_num",
                 "order_amount", "order_ct", "payment_amount", "paid_order_ct",
                 "refund_order_ct", "refund_amount", "comment_ct", "good_comment_ct", "ts"]
PROVINCE_STATS = ["stt", "edt", "province_id", "province_name", "area_code", "iso_code", "iso_3166_2",
                  "order_amount", "order_count", "ts"]
KEYWORD_STATS = ["keyword", "ct", "source", "stt", "edt", "ts"]
