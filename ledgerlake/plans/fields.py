"""Element layouts of the API arrays: column -> (JSON path, type).

A bare NUMBER has scale 0, so prices, balances and stock impacts round to whole units as ``decimal(38,0)``;
:func:`exact_money` keeps two decimals for callers that want them.
"""

from __future__ import annotations

WHOLE = "decimal(38,0)"

# Field names of the landed documents.
CUSTOMER = {
    "customer_number": ("$.customerNumber", "bigint"),
    "customer_name": ("$.name", "string"),
    "customer_group_number": ("$.customerGroup.customerGroupNumber", "bigint"),
    "currency": ("$.currency", "string"),
    "vatzone_number": ("$.vatZone.vatZoneNumber", "bigint"),
    "balance": ("$.balance", WHOLE),
    "due_amount": ("$.dueAmount", WHOLE),
    "country": ("$.country", "string"),
    "address": ("$.address", "string"),
    "city": ("$.city", "string"),
    "zip": ("$.zip", "string"),
    "email": ("$.email", "string"),
    "mobile_phone": ("$.mobilePhone", "string"),
    "telephone": ("$.telephoneAndFaxNumber", "string"),
    "salesperson_employee_number": ("$.salesPerson.employeeNumber", "bigint"),
    "payment_terms_number": ("$.paymentTerms.paymentTermsNumber", "bigint"),
    "attention_contact_number": ("$.attention.customerContactNumber", "bigint"),
    "customer_contact_number": ("$.customerContact.customerContactNumber", "bigint"),
    "last_updated": ("$.lastUpdated", "timestamp"),
}
PRODUCT = {
    "sku": ("$.productNumber", "string"),
    "product_name": ("$.name", "string"),
    "description": ("$.description", "string"),
    "sales_price": ("$.salesPrice", WHOLE),
    "recommended_price": ("$.recommendedPrice", WHOLE),
    "cost_price": ("$.costPrice", WHOLE),
    "barred": ("$.barred", "boolean"),
    "product_group_number": ("$.productGroup.productGroupNumber", "bigint"),
    "product_group_name": ("$.productGroup.name", "string"),
    "inventory_enabled": ("$.productGroup.inventoryEnabled", "boolean"),
    "unit_name": ("$.unit.name", "string"),
    "unit_number": ("$.unit.unitNumber", "bigint"),
    "last_updated": ("$.lastUpdated", "timestamp"),
}
INVOICE = {
    "invoice_number": ("$.bookedInvoiceNumber", "bigint"),
    "invoice_date": ("$.date", "date"),
    "due_date": ("$.dueDate", "date"),
    "customer_number": ("$.customer.customerNumber", "bigint"),
    "invoice_currency": ("$.currency", "string"),
    "exchange_rate": ("$.exchangeRate", "double"),
    "net_amount": ("$.netAmount", "double"),
    "net_amount_base_currency": ("$.netAmountInBaseCurrency", "double"),
    "gross_amount": ("$.grossAmount", "double"),
    "gross_amount_base_currency": ("$.grossAmountInBaseCurrency", "double"),
    "vat_amount": ("$.vatAmount", "double"),
    "rounding_amount": ("$.roundingAmount", "double"),
    "remainder": ("$.remainder", "double"),
    "remainder_base_currency": ("$.remainderInBaseCurrency", "double"),
    "delivery_address": ("$.delivery.address", "string"),
    "delivery_city": ("$.delivery.city", "string"),
    "delivery_country": ("$.delivery.country", "string"),
    "delivery_zip": ("$.delivery.zip", "string"),
    "delivery_location_number": ("$.deliveryLocation.deliveryLocationNumber", "bigint"),
    "recipient_name": ("$.recipient.name", "string"),
    "recipient_address": ("$.recipient.address", "string"),
    "recipient_city": ("$.recipient.city", "string"),
    "recipient_country": ("$.recipient.country", "string"),
    "recipient_zip": ("$.recipient.zip", "string"),
    "recipient_vatzone_number": ("$.recipient.vatZone.vatZoneNumber", "bigint"),
    "sales_person_employee_number": ("$.references.salesPerson.employeeNumber", "bigint"),
    "customer_contact_number": ("$.references.customerContact.customerContactNumber", "bigint"),
    "payment_terms_number": ("$.paymentTerms.paymentTermsNumber", "bigint"),
    "payment_days_of_credit": ("$.paymentTerms.daysOfCredit", "bigint"),
    "layout_number": ("$.layout.layoutNumber", "bigint"),
    "order_number": ("$.orderNumber", "bigint"),
}
INVOICE_LINE = {
    "invoice_number": ("$.documentId", "bigint"),
    "line_number": ("$.number", "bigint"),
    "line_number_ui": ("$.userInterfaceNumber", "bigint"),
    "sku": ("$.productNumber", "string"),
    "line_description": ("$.description", "string"),
    "quantity": ("$.quantity", "double"),
    "unit_net_price": ("$.unitNetPrice", "double"),
    "unit_cost_price": ("$.unitCostPrice", "double"),
    "line_net_amount": ("$.totalNetAmount", "double"),
    "discount_percentage": ("$.discountPercentage", "double"),
    "vat_rate": ("$.vatRate", "double"),
    "vat_amount": ("$.vatAmount", "double"),
}
SHOP_PRODUCT = {
    "product_id": ("$.id", "bigint"),
    "product_name": ("$.name", "string"),
    "id_category_default": ("$.id_category_default", "bigint"),
    "active": ("$.active", "boolean"),
    "date_added": ("$.date_add", "timestamp"),
    "date_updated": ("$.date_upd", "timestamp"),
}
SHOP_CATEGORY = {
    "category_id": ("$.id", "bigint"),
    "category_name_da": ("$.name", "string"),
    "parent_category_id": ("$.id_parent", "bigint"),
    "active": ("$.active", "boolean"),
    "level_depth": ("$.level_depth", "bigint"),
}
SHOP_COMBINATION = {
    "combination_id": ("$.id", "bigint"),
    "product_id": ("$.id_product", "bigint"),
    "sku": ("$.reference", "string"),
    "ean13": ("$.ean13", "string"),
    "price_impact": ("$.price", WHOLE),
    "quantity_in_stock": ("$.quantity", "bigint"),
}
SHOP_COMBINATION_ID = {"combination_id": ("$.id", "bigint")}
SHOP_OPTION_REF = {"option_value_id": ("$.id", "bigint")}
SHOP_OPTION_PATH = "$.associations.product_option_values"
SHOP_OPTION_VALUE = {
    "option_value_id": ("$.id", "bigint"),
    "option_group_id": ("$.id_attribute_group", "bigint"),
    "option_value_name": ("$.name", "string"),
}


def exact_money(fields: dict[str, tuple[str, str]]) -> dict[str, tuple[str, str]]:
    """The same fields with money kept at two decimals."""
    return {c: (path, "decimal(38,2)" if type_ == WHOLE else type_) for c, (path, type_) in fields.items()}
