"""Declared schemas of the star-schema tables, their keys and their critical columns."""

from __future__ import annotations

from pyspark.sql import types as T

# Table layouts as Spark DDL, in file column order, canonical names.
DDL = {
    "dim_customers": """customer_id STRING, first_name STRING, last_name STRING, email STRING,
        gender STRING, age SMALLINT, country STRING, city STRING, currency STRING,
        signup_date DATE, acquisition_channel STRING, customer_segment STRING,
        is_loyalty_member BOOLEAN, marketing_opt_in BOOLEAN""",
    "dim_products": """product_id STRING, product_name STRING, category STRING,
        subcategory STRING, brand STRING, unit_price DECIMAL(10,2), unit_cost DECIMAL(10,2),
        weight_kg DECIMAL(8,2), launch_date DATE, is_discontinued BOOLEAN,
        rating_avg DECIMAL(3,1), supplier_id INT, margin_pct DECIMAL(6,2)""",
    "dim_stores": """store_id STRING, store_name STRING, store_type STRING, country STRING,
        city STRING, square_footage INT, opened_date DATE, is_active BOOLEAN,
        manager_employee_id STRING""",
    "dim_employees": """employee_id STRING, first_name STRING, last_name STRING, role STRING,
        store_id STRING, hire_date DATE, annual_salary_usd DECIMAL(10,2),
        performance_rating DECIMAL(3,1), is_active BOOLEAN""",
    "dim_suppliers": """supplier_id INT, supplier_name STRING, country STRING,
        reliability_score DECIMAL(5,2), avg_lead_time_days SMALLINT,
        contract_start_date DATE, is_active BOOLEAN""",
    "dim_coupons": """coupon_id STRING, coupon_code STRING, discount_type STRING,
        discount_value DECIMAL(8,2), issue_date DATE, expiry_date DATE,
        min_purchase_amount DECIMAL(10,2), times_redeemed INT, is_active BOOLEAN""",
    "dim_holiday_calendar": """holiday_date DATE, holiday_name STRING,
        is_major_shopping_event BOOLEAN""",
    "fact_orders": """order_id STRING, customer_id STRING, store_id STRING, order_date DATE,
        channel STRING, order_status STRING, payment_method STRING,
        total_amount DECIMAL(12,2)""",
    "fact_order_items": """order_item_id STRING, order_id STRING, order_date DATE,
        product_id STRING, quantity SMALLINT, unit_price DECIMAL(10,2),
        discount_pct DECIMAL(5,4), line_revenue DECIMAL(12,2), line_cost DECIMAL(12,2),
        line_profit DECIMAL(12,2)""",
    "fact_payments": """payment_id STRING, order_id STRING, payment_date DATE,
        amount DECIMAL(12,2), payment_method STRING, payment_status STRING,
        transaction_fee_pct DECIMAL(6,4)""",
    "fact_returns": """return_id STRING, order_id STRING, order_item_id STRING,
        return_date DATE, return_reason STRING, refund_amount DECIMAL(12,2),
        restocked BOOLEAN""",
    "fact_shipping": """shipment_id STRING, order_id STRING, carrier STRING, ship_date DATE,
        delivery_date DATE, promised_delivery_days SMALLINT, actual_transit_days SMALLINT,
        is_delayed BOOLEAN, shipping_cost DECIMAL(8,2)""",
    "fact_inventory": """store_id STRING, product_id STRING, stock_on_hand INT,
        reorder_point INT, reorder_quantity INT, last_restocked_date DATE,
        stock_status STRING""",
    "fact_reviews": """review_id STRING, product_id STRING, order_id STRING,
        customer_id STRING, review_date DATE, rating SMALLINT, sentiment STRING,
        verified_purchase BOOLEAN, helpful_votes INT""",
    "fact_marketing_campaigns": """campaign_id STRING, campaign_name STRING,
        campaign_type STRING, channel STRING, target_country STRING, start_date DATE,
        end_date DATE, budget_usd DECIMAL(12,2), impressions BIGINT, clicks BIGINT,
        conversions BIGINT, revenue_generated_usd DECIMAL(12,2), ctr_pct DECIMAL(6,3),
        conversion_rate_pct DECIMAL(6,3), roas DECIMAL(8,2)""",
    "fact_website_traffic": """traffic_date DATE, country STRING, visitors INT, sessions INT,
        bounce_rate DECIMAL(5,3), conversion_rate DECIMAL(6,4),
        avg_session_duration_sec INT""",
    "fact_weather": """weather_date DATE, country STRING, city STRING,
        temperature_c DECIMAL(5,1), condition STRING, precipitation_mm DECIMAL(6,1)""",
    "fact_economic_indicators": """indicator_month DATE, country STRING,
        inflation_rate_pct DECIMAL(5,2), unemployment_rate_pct DECIMAL(5,2),
        consumer_confidence_index DECIMAL(6,1), gdp_growth_pct DECIMAL(5,2)""",
}

# Headers in the files that differ from the canonical column names.
FILE_HEADERS = {
    "dim_holiday_calendar": {"date": "holiday_date"},
    "fact_website_traffic": {"date": "traffic_date"},
    "fact_weather": {"date": "weather_date"},
    "fact_economic_indicators": {"month": "indicator_month"},
}

# The quality gate's columns that must never be null.
CRITICAL_COLUMNS = {
    "dim_customers": ["customer_id", "country", "signup_date"],
    "dim_products": ["product_id", "category", "unit_price", "unit_cost"],
    "fact_orders": ["order_id", "customer_id", "order_date", "total_amount"],
    "fact_order_items": ["order_id", "product_id", "quantity", "line_revenue"],
}

# Primary keys checked for uniqueness.
PRIMARY_KEYS = {
    "dim_customers": "customer_id",
    "dim_products": "product_id",
    "dim_stores": "store_id",
    "fact_orders": "order_id",
    "fact_order_items": "order_item_id",
}

# Fixed values: (child table, foreign key, parent table, primary key).
FOREIGN_KEYS = [
    ("fact_orders", "customer_id", "dim_customers", "customer_id"),
    ("fact_orders", "store_id", "dim_stores", "store_id"),
    ("fact_order_items", "order_id", "fact_orders", "order_id"),
    ("fact_order_items", "product_id", "dim_products", "product_id"),
    ("fact_returns", "order_id", "fact_orders", "order_id"),
    ("fact_reviews", "product_id", "dim_products", "product_id"),
]

TABLE_NAMES = tuple(DDL)


def schema_of(name: str) -> T.StructType:
    """Canonical schema of a table."""
    return T.StructType.fromDDL(DDL[name])


def file_schema_of(name: str) -> T.StructType:
    """Schema under the header names the files carry."""
    header = {canonical: raw for raw, canonical in FILE_HEADERS.get(name, {}).items()}
    return T.StructType([T.StructField(header.get(f.name, f.name), f.dataType)
                         for f in schema_of(name).fields])
