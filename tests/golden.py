"""Hand-made order and customer documents (all values invented)."""

from __future__ import annotations

import json
import os


def adj(i, price):
    return {"_type": "price_adjustment", "price_adjustment_id": f"PA{i}", "promotion_id": f"P{i}",
            "price": price, "item_text": "promo", "manual": False, "custom": False,
            "applied_discount": {"_type": "discount", "amount": 5, "type": "percentage"}}


def product(item_id, product_id, options=None):
    p = {"_type": "product_item", "item_id": item_id, "product_id": product_id,
         "product_name": f"Product {product_id}", "quantity": 1, "price": 10.5,
         "base_price": 10.5, "tax": 0.5, "tax_basis": 10.5, "shipment_id": "me",
         "c_personalizationJson": '{"x": 1}'}
    if options is not None:
        p["option_items"] = options
    return p


def option(item_id, option_id):
    return {"_type": "option_item", "item_id": item_id, "option_id": option_id,
            "option_value_id": f"{option_id}-v", "price": 1.25, "tax_basis": 1.25,
            "product_id": f"{option_id}-p", "quantity": 1}


def payment(pid, amount, card=True):
    p = {"_type": "order_payment_instrument", "payment_instrument_id": pid, "amount": amount,
         "payment_method_id": "CREDIT_CARD" if card else "GIFT_CERTIFICATE",
         "c_customerProfileId": "prof-1"}
    if card:
        p["payment_card"] = {"_type": "payment_card", "card_type": "Visa",
                             "masked_number": "************1111", "holder": "A Person"}
    else:
        p["masked_gift_certificate_code"] = "********ABCD"
    return p


def order(no, created="2024-03-10T09:59:59.000Z", modified="2024-03-10T10:00:00.000Z", **kw):
    d = {"_type": "order", "order_no": no, "creation_date": created, "last_modified": modified,
         "currency": "USD", "order_total": 21.0, "status": "new",
         "customer_name": "A Person", "order_token": "tok",
         "customer_info": {"_type": "customer_info", "customer_id": "c1", "customer_no": "007",
                           "customer_name": "A Person", "email": "a@example.com"},
         "billing_address": {"_type": "order_address", "id": "b1", "first_name": "A",
                             "last_name": "Person", "phone": "555"},
         "notes": {"_type": "simple_link", "link": f"/orders/{no}/notes"},
         "payment_instruments": [payment(f"{no}-p1", 15.75), payment(f"{no}-p2", 5.25, False)],
         "shipments": [{"_type": "shipment", "shipment_id": "me",
                        "shipping_address": {"first_name": "A", "last_name": "Person"}}],
         "shipping_items": [{"_type": "shipping_item", "item_id": "si1", "shipment_id": "me",
                             "price_adjustments": [adj(1, -1.0), adj(2, -2.0)]}],
         "product_items": [product("i1", "prod-1", [option("o1", "opt-a"), option("o2", "opt-b")]),
                           product("i2", "prod-2")]}
    d.update(kw)
    return {k: v for k, v in d.items() if v is not ...}


ABSENT = ...


def order_documents():
    """Golden order documents, numbered as in FIXTURES.md."""
    docs = [
        order("1"),                                                  # full document
        order("2", product_items=ABSENT),                            # products absent
        order("3", product_items=[]),                                # products empty
        order("4", payment_instruments=[]),                          # payments empty
        order("5", shipments=ABSENT),                                # shipments absent
        order("6", shipping_items=[{"_type": "shipping_item", "item_id": "si1",
                                    "price_adjustments": []}]),      # adjustments empty
        order("7", shipping_items=[{"_type": "shipping_item", "item_id": "si1"},
                                   {"_type": "shipping_item", "item_id": "si2",
                                    "price_adjustments": [adj(9, -9.0)]}]),
        order("8", customer_info={"_type": "customer_info", "customer_id": "c8",
                                  "customer_no": "0008"}),           # e-mail key absent
        order("9", customer_info={"_type": "customer_info", "customer_id": "c9",
                                  "customer_no": "0009", "email": None}),  # e-mail null
        order("10", created="2024-03-10T23:59:59.500Z", modified="2024-03-10T23:59:59.500Z"),
        order("12", modified="2024-03-10T11:00:00.000Z"),
        order("12", modified="2024-03-10T12:00:00.000Z",
              product_items=[product("i1", "prod-1"), product("i1", "prod-1")]),
    ]
    return docs


def customer_documents():
    full = {"customer_id": "k1", "customer_no": "00042", "email": "k1@example.com",
            "first_name": "K", "last_name": "One", "phone_home": "0123", "gender": 1,
            "creation_date": "2024-03-10T09:59:59.000Z", "last_modified": "2024-03-10T10:00:00Z",
            "last_login_time": "2024-03-10T10:00:00.000Z", "c_pointsBalance": 12.5,
            "c_vipStatus": "gold"}
    only_id = {"customer_id": "k2", "creation_date": "2024-03-10T01:00:00.000Z",
               "last_modified": "2024-03-10T01:00:00.000Z"}
    no_logins = {"customer_id": "k3", "customer_no": "00003",
                 "creation_date": "2024-03-09T01:00:00.000Z",
                 "last_modified": "2024-03-10T02:00:00.000Z"}
    return [full, only_id, no_logins]


def write_envelopes(folder: str, docs, page_size: int = 5) -> str:
    """Land documents as search responses, one response per line."""
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, "responses.json")
    with open(path, "w") as fh:
        for i in range(0, len(docs), page_size):
            page = docs[i:i + page_size]
            fh.write(json.dumps({"total": len(docs), "count": len(page), "start": i,
                                 "hits": [{"data": d} for d in page]}) + "\n")
    return folder
