"""Declared Bronze schemas, file names and table notes."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {"long": T.LongType(), "text": T.StringType(), "date": T.DateType(), "float": T.DoubleType()}


def _schema(spec: str) -> T.StructType:
    fields = (item.split(":") for item in spec.split())
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


CSV_SCHEMAS = {
    "customer_demographics": _schema(
        "customer_id:long name:text date_of_birth:date gender:text region:text country:text city:text"
        " marital_status:text annual_income:long"
    ),
    "customer_service_interactions": _schema(
        "interaction_id:text interaction_date:date interaction_type:text issue_category:text description:text"
        " duration_minutes:long resolution_status:text follow_up_required:text customer_satisfaction:long"
        " customer_id:long order_id:long"
    ),
    "financial_transactions": _schema(
        "transaction_id:text transaction_date:date transaction_type:text amount:text payment_method:text"
        " entity:text region:text account_code:text"
    ),
    "promotions_data": _schema(
        "promotion_id:text product_category:text promotion_type:text discount_percentage:float start_date:date"
        " end_date:date region:text"
    ),
    "marketing_campaigns": _schema(
        "campaign_id:text campaign_name:text campaign_type:text product_category:text target_audience:text"
        " start_date:date end_date:date region:text budget:long reach:long conversion_rate:float"
    ),
    "logistics_and_shipping": _schema(
        "shipment_id:text order_id:long ship_date:date estimated_delivery:date shipping_method:text status:text"
        " shipping_cost:text destination_region:text destination_country:text carrier:text"
    ),
    "supplier_information": _schema(
        "supplier_id:text supplier_name:text product_category:text region:text country:text city:text"
        " lead_time:long reliability_score:float quality_rating:text"
    ),
    "employee_records": _schema(
        "employee_id:text name:text date_of_birth:date hire_date:date department:text job_title:text salary:text"
        " region:text country:text email:text"
    ),
}

# Trailing columns the cross-domain analyses join on; files without them load with NULLs.
OPTIONAL_COLUMNS = {"customer_service_interactions": ("customer_id", "order_id")}

# "quoted": a quoted field may hold line breaks, so a file is one task; "lines": every line is a record, so that large files
# split. Tables of codes, dates and numbers are declared as lines, those with free text as quoted.
CSV_LAYOUT = {
    "customer_demographics": "quoted",
    "customer_service_interactions": "quoted",
    "financial_transactions": "lines",
    "promotions_data": "lines",
    "marketing_campaigns": "quoted",
    "logistics_and_shipping": "lines",
    "supplier_information": "quoted",
    "employee_records": "quoted",
}
RAW_LINE_TABLES = ("product_reviews",)
JSON_TABLES = ("inventory_staging", "store_locations_staging")
# "documents": a file is one document, or one a line; "lines": always one a line, so that large files split; "elements": a file
# is one array of objects, read object by object.
JSON_LAYOUT = {"inventory_staging": "documents", "store_locations_staging": "documents"}
BRONZE_TABLES = (*CSV_SCHEMAS, *RAW_LINE_TABLES, *JSON_TABLES)

# File name of each Bronze table under the landing folder.
FILES = {
    "customer_demographics": "customer_demographics.csv",
    "customer_service_interactions": "customer_service_interactions.csv",
    "financial_transactions": "financial_transactions.csv",
    "promotions_data": "promotions-data.csv",
    "marketing_campaigns": "marketing_campaigns.csv",
    "logistics_and_shipping": "logistics_and_shipping.csv",
    "supplier_information": "supplier_information.csv",
    "employee_records": "employee_records.csv",
    "product_reviews": "product_reviews.csv",
    "inventory_staging": "inventory.json",
    "store_locations_staging": "store_locations.json",
}

# Array element fields of the two JSON tables: (field, type).
INVENTORY_FIELDS = (
    ("product_id", "string"),
    ("product_category", "string"),
    ("region", "string"),
    ("country", "string"),
    ("warehouse", "string"),
    ("current_stock", "bigint"),
    ("reorder_point", "bigint"),
    ("lead_time", "bigint"),
    ("last_restock_date", "date"),
)
STORE_FIELDS = (
    ("store_id", "string"),
    ("store_name", "string"),
    ("store_type", "string"),
    ("region", "string"),
    ("country", "string"),
    ("city", "string"),
    ("address", "string"),
    ("postal_code", "bigint"),
    ("square_footage", "decimal(10,2)"),
    ("employee_count", "bigint"),
)
JSON_FIELDS = {"inventory_staging": INVENTORY_FIELDS, "store_locations_staging": STORE_FIELDS}
