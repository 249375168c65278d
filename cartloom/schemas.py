"""Schemas of the landed documents and of the flat entity tables.

Landed search responses are scanned with these explicit schemas (no inference:
inference costs a full extra pass over 100 TB and makes types depend on the
slice). Stamps arrive as ISO text in UTC (``...T...Z``) and are parsed into
``TIMESTAMP_NTZ`` UTC wall clock by :func:`cartloom.functions.timefmt.parse_utc`.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, B, I, L = T.StringType(), T.DoubleType(), T.BooleanType(), T.IntegerType(), T.LongType()
TS = T.TimestampNTZType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# --------------------------------------------------------------------------
# Landed documents (input). Money is DECIMAL(18,2) in the canonical schema.
# --------------------------------------------------------------------------
MONEY = T.DecimalType(18, 2)

APPLIED_DISCOUNT = _struct(("_type", S), ("amount", MONEY), ("type", S))

PRICE_ADJUSTMENT = _struct(
    ("_type", S), ("creation_date", S), ("custom", B), ("item_text", S),
    ("last_modified", S), ("manual", B), ("price", MONEY), ("price_adjustment_id", S),
    ("promotion_id", S), ("promotion_link", S), ("applied_discount", APPLIED_DISCOUNT),
)

OPTION_ITEM = _struct(
    ("_type", S), ("adjusted_tax", MONEY), ("base_price", MONEY), ("bonus_product_line_item", B),
    ("gift", B), ("item_id", S), ("item_text", S), ("option_id", S), ("option_value_id", S),
    ("price", MONEY), ("price_after_item_discount", MONEY), ("price_after_order_discount", MONEY),
    ("product_id", S), ("product_name", S), ("quantity", D), ("shipment_id", S), ("tax", MONEY),
    ("tax_basis", MONEY), ("tax_class_id", S), ("tax_rate", D), ("c_OptionType", S),
    ("c_ProductReference", S), ("c_Type", S),
)

PRODUCT_ITEM = _struct(
    ("_type", S), ("adjusted_tax", MONEY), ("base_price", MONEY), ("bonus_product_line_item", B),
    ("gift", B), ("item_id", S), ("item_text", S), ("price", MONEY),
    ("price_after_item_discount", MONEY), ("price_after_order_discount", MONEY),
    ("product_id", S), ("product_name", S), ("quantity", D), ("shipment_id", S),
    ("shipping_item_id", S), ("tax", MONEY), ("tax_basis", MONEY), ("tax_class_id", S),
    ("tax_rate", D), ("c_OptionType", S), ("c_Type", S), ("c_inStockDate", S),
    ("c_isBackorder", B), ("c_isRRP", B), ("c_msscBrand", S), ("c_personalizationJson", S),
    ("c_personalizationEligible", B), ("option_items", T.ArrayType(OPTION_ITEM)),
)

PAYMENT_CARD = _struct(("_type", S), ("card_type", S), ("masked_number", S), ("holder", S),
                       ("expiration_month", I), ("expiration_year", I))

PAYMENT_INSTRUMENT = _struct(
    ("_type", S), ("payment_instrument_id", S), ("amount", MONEY), ("payment_method_id", S),
    ("c_customerProfileId", S), ("c_customerPaymentProfileId", S),
    ("masked_gift_certificate_code", S), ("payment_card", PAYMENT_CARD),
)

ADDRESS = _struct(("_type", S), ("id", S), ("address1", S), ("first_name", S), ("last_name", S),
                  ("full_name", S), ("phone", S), ("city", S), ("postal_code", S))

SHIPMENT = _struct(("_type", S), ("shipment_id", S), ("shipment_no", S), ("shipping_method", S),
                   ("shipping_address", ADDRESS))

SHIPPING_ITEM = _struct(("_type", S), ("item_id", S), ("shipment_id", S), ("price", MONEY),
                        ("price_adjustments", T.ArrayType(PRICE_ADJUSTMENT)))

CUSTOMER_INFO = _struct(("_type", S), ("customer_id", S), ("customer_no", S),
                        ("customer_name", S), ("email", S))

NOTES = _struct(("_type", S), ("link", S))

ORDER_DOCUMENT = _struct(
    ("_type", S), ("order_no", S), ("adjusted_merchandize_total_tax", MONEY),
    ("adjusted_shipping_total_tax", MONEY), ("confirmation_status", S), ("created_by", S),
    ("creation_date", S), ("currency", S), ("export_status", S), ("last_modified", S),
    ("merchandize_total_tax", MONEY), ("order_total", MONEY), ("payment_status", S),
    ("product_sub_total", MONEY), ("product_total", MONEY), ("shipping_status", S),
    ("shipping_total", MONEY), ("shipping_total_tax", MONEY), ("site_id", S), ("status", S),
    ("taxation", S), ("tax_total", MONEY), ("c_ATCustomsDuty", MONEY), ("c_ATTax", MONEY),
    ("c_mcOrderConfirmationStatusFailed", B), ("c_IPAddress", S),
    ("customer_name", S), ("order_token", S),
    ("customer_info", CUSTOMER_INFO), ("billing_address", ADDRESS), ("notes", NOTES),
    ("payment_instruments", T.ArrayType(PAYMENT_INSTRUMENT)),
    ("shipments", T.ArrayType(SHIPMENT)),
    ("shipping_items", T.ArrayType(SHIPPING_ITEM)),
    ("product_items", T.ArrayType(PRODUCT_ITEM)),
)

CUSTOMER_DOCUMENT = _struct(
    ("customer_id", S), ("birthday", S), ("company_name", S), ("creation_date", S),
    ("customer_no", S), ("email", S), ("first_name", S), ("gender", I), ("last_login_time", S),
    ("last_modified", S), ("last_name", S), ("last_visit_time", S), ("phone_business", S),
    ("phone_home", S), ("phone_mobile", S), ("previous_login_time", S),
    ("previous_visit_time", S), ("c_cordialSubscribed", S), ("c_cordialList", S),
    ("c_cordialCID", S), ("c_subscribed", S), ("c_isLoyaltyMember", S), ("c_vipStatus", S),
    ("c_isLoyaltyProgramInitialized", S), ("c_aListStatus", S), ("c_freeEconomyShipping", S),
    ("c_pointsBalance", D), ("c_vipExpireStatus", S), ("c_vipExtensionStatus", S),
    ("c_vipPointsNeeded", D), ("c_aListMembershipTier", D),
)


def envelope_schema(document: T.StructType) -> T.StructType:
    """Search response: ``{total, count, start, hits: [{data: document}]}``, with the request's
    range filter if the response repeats it (``query``)."""
    return _struct(("total", L), ("count", L), ("start", L), ("query", REQUEST_ECHO),
                   ("hits", T.ArrayType(_struct(("data", document)))))


#: The range filter of a request as its response repeats it.
REQUEST_ECHO = _struct(("filtered_query", _struct(("filter", _struct(
    ("range_filter", _struct(("field", S), ("from", S), ("to", S))))))))


ORDER_ENVELOPE = envelope_schema(ORDER_DOCUMENT)
CUSTOMER_ENVELOPE = envelope_schema(CUSTOMER_DOCUMENT)


# --------------------------------------------------------------------------
# The output column lists of the flat tables, in the order the
# published files carry them. They must equal the published layout, so they
# are stated here as plain text.
# --------------------------------------------------------------------------
ORDER_COLUMNS = [
    "order__type", "order_adjusted_merchandize_total_tax", "order_adjusted_shipping_total_tax",
    "order_confirmation_status", "order_created_by", "order_creation_date",
    "order_creation_pst_date", "order_currency", "order_export_status", "order_last_modified",
    "order_last_modified_pst_date", "order_merchandize_total_tax", "order_order_no",
    "order_order_total", "order_payment_status", "order_product_sub_total",
    "order_product_total", "order_shipping_status", "order_shipping_total",
    "order_shipping_total_tax", "order_site_id", "order_status", "order_taxation",
    "order_tax_total", "order_c_ATCustomsDuty", "order_c_ATTax",
    "order_c_mcOrderConfirmationStatusFailed", "order_c_IPAddress",
    "order_customer_info._type", "order_customer_info.customer_id",
    "order_customer_info.customer_no", "customer_emails", "order_notes._type",
    "order_notes.link", "file_name",
]

PRODUCT_COLUMNS = [
    "order_order_no", "product_item__type", "product_item_adjusted_tax",
    "product_item_base_price", "product_item_bonus_product_line_item", "product_item_gift",
    "product_item_item_id", "product_item_item_text", "product_item_price",
    "product_item_price_after_item_discount", "product_item_price_after_order_discount",
    "product_item_product_id", "product_item_product_name", "product_item_quantity",
    "product_item_shipment_id", "product_item_tax", "product_item_tax_basis",
    "product_item_tax_class_id", "product_item_tax_rate", "product_item_c_OptionType",
    "product_item_c_Type", "product_item_c_inStockDate", "product_item_c_isBackorder",
    "product_item_c_isRRP", "product_item_c_msscBrand", "product_item_c_personalizationJson",
    "product_item_option_items", "product_item_c_personalizationEligible", "file_name",
]

OPTION_ITEM_COLUMNS = [
    "order_no", "product_items_product_id", "product_item_item_id", "option_items__type",
    "option_items_adjusted_tax", "option_items_base_price",
    "option_items_bonus_product_line_item", "option_items_gift", "option_items_item_id",
    "option_items_item_text", "option_items_option_id", "option_items_option_value_id",
    "option_items_price", "option_items_price_after_item_discount",
    "option_items_price_after_order_discount", "option_items_product_id",
    "option_items_product_name", "option_items_quantity", "option_items_shipment_id",
    "option_items_tax", "option_items_tax_basis", "option_items_tax_class_id",
    "option_items_tax_rate", "option_items_c_OptionType", "option_items_c_ProductReference",
    "option_items_c_Type", "file_name",
]

PAYMENT_COLUMNS = [
    "order_order_no", "payment_inst_payment_instrument_id", "payment_inst_amount",
    "payment_inst_payment_method_id", "payment_inst_c_customerProfileId",
    "payment_inst_payment_card.card_type", "payment_inst_payment_card.masked_number",
    "payment_inst_masked_gift_certificate_code", "file_name",
]

CUSTOMER_COLUMNS = [
    "customer_id", "birthday", "company_name", "creation_date", "creation_date_pst",
    "customer_no", "email", "first_name", "gender", "last_login_time", "last_login_time_pst",
    "last_modified", "last_modified_pst", "last_name", "last_visit_time",
    "last_visit_time_pst", "phone_business", "phone_home", "phone_mobile",
    "previous_login_time", "previous_login_time_pst", "previous_visit_time",
    "previous_visit_time_pst", "c_cordialSubscribed", "c_cordialList", "c_cordialCID",
    "c_subscribed", "c_isLoyaltyMember", "c_vipStatus", "c_isLoyaltyProgramInitialized",
    "c_aListStatus", "c_freeEconomyShipping", "c_pointsBalance", "c_vipExpireStatus",
    "c_vipExtensionStatus", "c_vipPointsNeeded", "c_aListMembershipTier", "file_name",
]

# Order columns left out of the subset dedup of the day merge (the four stamps).
ORDER_STAMP_COLUMNS = ["order_creation_date", "order_creation_pst_date",
                       "order_last_modified", "order_last_modified_pst_date"]

# Customer stamps converted to Pacific time, each gaining a ``<name>_pst`` column.
CUSTOMER_STAMP_COLUMNS = ["creation_date", "last_login_time", "last_modified",
                          "last_visit_time", "previous_login_time", "previous_visit_time"]

# Customer keys and their defaults when absent: text '' , gender null, numbers NaN.
CUSTOMER_NUMERIC_COLUMNS = ["c_pointsBalance", "c_vipPointsNeeded", "c_aListMembershipTier"]

# Lineage column value of a merged day file: "<word>_data_<yyyyMMdd>.csv", with
# the words below per table.
DAY_FILE_FORMAT = "%s_data_%s.csv"
ORDERS_FILE_WORD = "orders"
PRODUCTS_FILE_WORD = "products"
OPTION_ITEMS_FILE_WORD = "option_items"
PAYMENTS_FILE_WORD = "payment_details"
CUSTOMERS_FILE_WORD = "customers"

# Constant written over the product personalisation text at the day merge.
PERSONALIZATION_OVERRIDE = "NAN"

# Text hashed for a missing e-mail by the compat mask.
MISSING_EMAIL_TEXT = "nan"

# Log keys of the day-file counts (total, created, modified-not-created, all modified).
DAY_COUNT_LOG_KEYS = ["total_orders_today", "orders_created_today", "orders_modified_today",
                      "total_modified"]

# Page size and refinement threshold of the search service.
PAGE_SIZE = 200

# Slice ladders in seconds: orders 15 min -> 5 min -> 1 min -> 1 s;
# customers 1 h -> 30 min -> 15 min -> 5 min -> 1 min -> 1 s.
ORDER_LADDER = (900, 300, 60, 1)
CUSTOMER_LADDER = (3600, 1800, 900, 300, 60, 1)

PACIFIC = "US/Pacific"
