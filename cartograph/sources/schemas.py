"""Explicit schemas of the three retail tables and the engineered feature row.

Declared rather than inferred: inference costs a second pass over the fact
file and can read zero-padded ids as numbers.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The column names and types of the three files.
TRANSACTIONS = T.StructType([
    T.StructField("t_dat", T.DateType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("article_id", T.LongType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("sales_channel_id", T.IntegerType()),
])

CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("FN", T.DoubleType()),
    T.StructField("Active", T.DoubleType()),
    T.StructField("club_member_status", T.StringType()),
    T.StructField("fashion_news_frequency", T.StringType()),
    T.StructField("age", T.DoubleType()),
    T.StructField("postal_code", T.StringType()),
])

# Of the 25 columns of the product table, those that the analytics name.
ARTICLE_NAMED_COLUMNS = [
    "article_id", "prod_name", "product_type_name", "product_group_name",
    "colour_group_name", "perceived_colour_master_name", "graphical_appearance_name",
    "department_name", "garment_group_name", "section_name", "index_group_name",
]

ARTICLES = T.StructType(
    [T.StructField("article_id", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in ARTICLE_NAMED_COLUMNS[1:]]
)

# The churn feature row in its output order, and the model inputs.
CHURN_FEATURE_COLUMNS = [
    "customer_id", "last_purchase_date", "first_purchase_date", "total_purchases",
    "unique_shopping_days", "unique_products", "total_spend", "avg_order_value",
    "days_since_last_purchase", "customer_tenure_days", "purchase_frequency",
    "avg_days_between_purchases", "std_days_between_purchases", "online_ratio",
    "weekend_ratio", "is_churned", "age", "club_member_status", "fashion_news_frequency",
]

NUMERIC_MODEL_FEATURES = [
    "total_purchases", "total_spend", "avg_order_value", "unique_products",
    "customer_tenure_days", "purchase_frequency", "days_since_last_purchase",
    "avg_days_between_purchases", "std_days_between_purchases", "online_ratio",
    "weekend_ratio",
]
CATEGORICAL_MODEL_FEATURES = ["club_member_status", "fashion_news_frequency"]
