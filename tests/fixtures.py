"""Small documents in the landed shapes."""

from __future__ import annotations

FIRST, SECOND = "2025-01-01 00:00:00", "2025-02-01 00:00:00"


def customer(number, name="Shop", group=2, **more):
    return {"customerNumber": number, "name": name, "customerGroup": {"customerGroupNumber": group}, **more}


def invoice(number, date="2025-01-10", rate=None, customer_number=1, delivery=None, recipient=None, currency="DKK", **more):
    doc = {"bookedInvoiceNumber": number, "date": date, "customer": {"customerNumber": customer_number},
           "currency": currency, "delivery": {"country": delivery}, "recipient": {"country": recipient}, **more}
    return {**doc, "exchangeRate": rate} if rate is not None else doc


def line(invoice_number, number, sku="A1", amount=100.0, quantity=1, **more):
    return {"documentId": invoice_number, "number": number, "userInterfaceNumber": number, "productNumber": sku,
            "description": f"{sku} text", "quantity": quantity, "unitNetPrice": amount, "totalNetAmount": amount, **more}


SAMPLE_INVOICE = invoice(10001522, "2018-03-19", 744.859813, 1154, "FR", "FR", "EUR", netAmountInBaseCurrency=294.89)
SAMPLE_LINES = [line(10001522, 1, "HAR111213", 33.56), line(10001522, 2, "fragtmm", 6.03)]

SHOP_PAGES = [
    (FIRST, "products", 0, {"products": [
        {"id": 1, "name": "Old Harness", "id_category_default": "10", "active": "1", "date_upd": "2024-05-01 10:00:00"},
        {"id": 2, "name": "Mystery", "id_category_default": "2", "active": "0"}]}),
    (SECOND, "products", 0, {"products": [
        {"id": 1, "name": "Harness", "id_category_default": "10", "active": "1", "date_upd": "2024-06-01 10:00:00"}]}),
    (FIRST, "categories", 0, {"categories": [
        {"id": 10, "name": "Harnesses", "id_parent": 2, "active": "1", "level_depth": 3},
        {"id": 2, "name": "Shop", "id_parent": 1, "active": "1", "level_depth": 1}]}),
    (FIRST, "combinations", 0, {"combinations": [
        {"id": 100, "id_product": 1, "reference": "A1", "ean13": "57", "price": 2.5, "quantity": 4,
         "associations": {"product_option_values": [{"id": 12}, {"id": 11}, {"id": 21}, {"id": 31}]}},
        {"id": 101, "id_product": 2, "reference": "B1", "price": 0, "quantity": 0},
        {"id": 102, "id_product": 1, "reference": None, "price": 0, "quantity": 0},
        {"id": 103, "id_product": 99, "reference": "C1", "price": 0, "quantity": 0,
         "associations": {"product_option_values": []}}]}),
    (FIRST, "product_option_values", 0, {"product_option_values": [
        {"id": 11, "id_attribute_group": 1, "name": "S"}, {"id": 12, "id_attribute_group": 1, "name": "M"},
        {"id": 21, "id_attribute_group": 2, "name": "Black"}, {"id": 31, "id_attribute_group": 3, "name": "Soft"}]}),
]

EXPIRED_ROWS = [
    # PRODUCT, COLOR, SIZE, SKU, EAN, CATEGORY_NO, CATEGORY_NAME
    ("Leash", "Red", "M", " exp1 ", "58", "7", "Leads"),
    ("Leash", "Blue", "M", "exp2", " ", "7", "Leads"),
    (" ", "Red", " ", "exp3", None, "abc", "Odd"),
    ("Bowl", None, "L", "  ", None, "8", " "),
    (None, "Red", "L", "a1", "59", None, None),
]
EXPIRED_SCHEMA = "PRODUCT string, COLOR string, SIZE string, SKU string, EAN string, CATEGORY_NO string, CATEGORY_NAME string"
