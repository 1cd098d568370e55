"""SQL building blocks for the DuckDB oracle.

The oracle reads the driver's raw tables (region … conversations views) and
re-derives the adapters itself, so every check covers the adapter too.
Floating results are rounded half away from zero at 6 decimals on both sides
(``round(x * 1e6) / 1e6``), because sums evaluated in different orders differ in
the last bits.
"""

from __future__ import annotations

# Adapter CTEs (FIXTURES.md §2), written independently of the Spark code.
TX = """tx AS (
  SELECT CAST(o.o_orderdate AS DATE) AS t_dat,
         o.o_custkey AS customer_id,
         l.l_partkey AS article_id,
         l.l_extendedprice AS price,
         CAST(CASE WHEN l.l_linestatus = 'O' THEN 2 ELSE 1 END AS INTEGER) AS sales_channel_id
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

CUST = """cust AS (
  SELECT c_custkey AS customer_id,
         CAST(CASE WHEN c_custkey % 3 = 0 THEN 1 END AS DOUBLE) AS "FN",
         CAST(CASE WHEN c_custkey % 4 = 0 THEN 1 END AS DOUBLE) AS "Active",
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'ACTIVE' WHEN 'BUILDING' THEN 'ACTIVE'
              WHEN 'HOUSEHOLD' THEN 'PRE-CREATE' WHEN 'FURNITURE' THEN 'LEFT CLUB' END
           AS club_member_status,
         CASE c_nationkey % 4 WHEN 1 THEN 'NONE' WHEN 2 THEN 'Regularly' WHEN 3 THEN 'Monthly' END
           AS fashion_news_frequency,
         CAST(CASE WHEN c_acctbal < 0 THEN NULL ELSE 16 + c_custkey % 85 END AS DOUBLE) AS age,
         CAST(c_nationkey AS VARCHAR) AS postal_code
  FROM customer)"""

ART = """art AS (
  SELECT p_partkey AS article_id, p_name AS prod_name, p_brand AS product_type_name,
         p_type AS product_group_name, split_part(p_name, ' ', 1) AS colour_group_name,
         CAST(p_size // 10 AS VARCHAR) AS garment_group_name
  FROM part)"""


def R(expr: str) -> str:
    """6-decimal rounding identical to the Spark side."""
    return f"(round(({expr}) * 1e6) / 1e6)"


def M(expr: str) -> str:
    """Exact money sum (cents) as double, matching ``money_sum(..., scale=2)``."""
    return f"CAST(sum(CAST({expr} AS DECIMAL(18,2))) AS DOUBLE)"


def S(expr: str) -> str:
    """Exact-moment sample std dev of a money column (cents), matching ``money_stddev(..., scale=2)``."""
    x = f"CAST(round(({expr}) * 100) AS HUGEINT)"
    return (f"(CASE WHEN count({x}) > 1 THEN sqrt(CAST(count({x}) * sum({x} * {x}) - sum({x}) * sum({x}) AS DOUBLE)"
            f" / CAST(count({x}) * (count({x}) - 1) AS DOUBLE)) / 100.0 END)")


def D(s: str) -> str:
    return f"DATE '{s}'"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join([TX, CUST, ART, *ctes]) + "\n"


def churn_feature_ctes(cutoff: str, end: str, fill_avg: str = "999.0", fill_std: str = "0.0",
                       fill_online: str = "0.5", fill_weekend: str = "0.3") -> list[str]:
    """CTE ``feat``: the 19-column churn feature row, written the direct way
    (separate aggregates and joins as the reference phrases it)."""
    return [
        f"train AS (SELECT * FROM tx WHERE t_dat < {D(cutoff)})",
        f"lab AS (SELECT DISTINCT customer_id FROM tx WHERE t_dat >= {D(cutoff)} AND t_dat < {D(end)})",
        f"""rfm AS (SELECT customer_id, max(t_dat) AS last_purchase_date, min(t_dat) AS first_purchase_date,
                   count(*) AS total_purchases, count(DISTINCT t_dat) AS unique_shopping_days,
                   count(DISTINCT article_id) AS unique_products, {M('price')} AS total_spend,
                   {M('price')} / count(price) AS avg_order_value FROM train GROUP BY customer_id)""",
        """gaps AS (SELECT customer_id,
                   date_diff('day', lag(t_dat) OVER (PARTITION BY customer_id ORDER BY t_dat), t_dat) AS g
                   FROM (SELECT DISTINCT customer_id, t_dat FROM train) d)""",
        """iv AS (SELECT customer_id, avg(g) AS a, stddev_samp(g) AS s FROM gaps
                  WHERE g IS NOT NULL GROUP BY customer_id)""",
        """beh AS (SELECT customer_id,
                   sum(CASE WHEN sales_channel_id = 2 THEN 1 ELSE 0 END) / count(*) AS online_ratio,
                   avg(CASE WHEN dayofweek(t_dat) IN (0, 6) THEN 1 ELSE 0 END) AS weekend_ratio
                   FROM train GROUP BY customer_id)""",
        f"""feat AS (SELECT r.customer_id, r.last_purchase_date, r.first_purchase_date,
                   CAST(r.total_purchases AS BIGINT) AS total_purchases,
                   CAST(r.unique_shopping_days AS BIGINT) AS unique_shopping_days,
                   CAST(r.unique_products AS BIGINT) AS unique_products,
                   r.total_spend, r.avg_order_value,
                   CAST(date_diff('day', r.last_purchase_date, {D(cutoff)}) AS INTEGER) AS days_since_last_purchase,
                   CAST(date_diff('day', r.first_purchase_date, {D(cutoff)}) AS INTEGER) AS customer_tenure_days,
                   r.total_purchases / (date_diff('day', r.first_purchase_date, {D(cutoff)}) + 1) AS purchase_frequency,
                   coalesce(iv.a, {fill_avg}) AS avg_days_between_purchases,
                   coalesce(iv.s, {fill_std}) AS std_days_between_purchases,
                   coalesce(b.online_ratio, {fill_online}) AS online_ratio,
                   coalesce(b.weekend_ratio, {fill_weekend}) AS weekend_ratio,
                   CAST(CASE WHEN lab.customer_id IS NULL THEN 1 ELSE 0 END AS INTEGER) AS is_churned,
                   c.age, c.club_member_status, c.fashion_news_frequency
                   FROM rfm r LEFT JOIN iv ON r.customer_id = iv.customer_id
                   LEFT JOIN beh b ON r.customer_id = b.customer_id
                   LEFT JOIN lab ON r.customer_id = lab.customer_id
                   LEFT JOIN cust c ON r.customer_id = c.customer_id)""",
    ]


FEATURE_DOUBLES = ["total_spend", "avg_order_value", "purchase_frequency",
                   "avg_days_between_purchases", "std_days_between_purchases",
                   "online_ratio", "weekend_ratio", "age"]


def rounded_select(source: str, cols: list[str], doubles: list[str]) -> str:
    return "SELECT " + ", ".join(f"{R(c)} AS {c}" if c in doubles else c for c in cols) + f" FROM {source}"
