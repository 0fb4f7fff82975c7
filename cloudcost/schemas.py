"""FIXED VALUES: keys and column orders of the daily tables.

They are the table schemas that readers and writers share and must stay as listed.
"""

AWS_KEYS = ["usage_date", "billing_month", "usage_account_id", "service_code", "sku_id",
            "region", "billing_type", "usage_type"]
AWS_DESCRIPTORS = ["service_name", "location", "currency", "pricing_type", "usage_amount", "usage_unit"]
AWS_INTERNAL = ["unblended_cost", "blended_cost", "net_unblended_cost"]
AWS_EXTERNAL = ["ext_unblended_cost", "ext_blended_cost", "ext_net_unblended_cost"]
AWS_COLUMNS = ["usage_date", "billing_month", "usage_account_id", "service_code", "service_name",
               "sku_id", "region", "location", "currency", "pricing_type", "billing_type",
               "usage_type", "usage_amount", "usage_unit"] + AWS_INTERNAL + AWS_EXTERNAL

GCP_KEYS = ["usage_date", "billing_account_id", "project_id", "service_code", "sku_id",
            "region", "cost_type"]
GCP_DESCRIPTORS = ["billing_month", "project_name", "service_name", "sku_description", "location",
                   "currency", "usage_amount", "usage_unit"]
GCP_INTERNAL = ["cost", "credits"]
GCP_EXTERNAL = ["ext_cost", "ext_credits"]
GCP_COLUMNS = ["usage_date", "billing_month", "billing_account_id", "project_id", "project_name",
               "service_code", "service_name", "sku_id", "sku_description", "region", "location",
               "currency", "cost_type", "usage_amount", "usage_unit"] + GCP_INTERNAL + GCP_EXTERNAL

HWC_KEYS = ["bill_date", "billing_month", "payer_account_id", "customer_id", "enterprise_project_id",
            "cloud_service_type", "sku_code", "resource_type_code", "region", "charge_mode", "bill_type"]
HWC_DESCRIPTORS = ["enterprise_project_name", "cloud_service_type_name", "product_spec_desc",
                   "resource_type_name", "resource_name", "region_name", "usage_amount"]
HWC_INTERNAL = ["consume_amount", "debt_amount", "official_amount"]
HWC_EXTERNAL = ["ext_consume_amount", "ext_debt_amount", "ext_official_amount"]
HWC_COLUMNS = ["bill_date", "billing_month", "payer_account_id", "customer_id", "enterprise_project_id",
               "enterprise_project_name", "cloud_service_type", "cloud_service_type_name", "sku_code",
               "product_spec_desc", "resource_type_code", "resource_type_name", "resource_name",
               "region", "region_name", "charge_mode", "bill_type", "usage_amount"] \
    + HWC_INTERNAL + HWC_EXTERNAL
