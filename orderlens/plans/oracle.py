"""ANSI-SQL oracles (DuckDB dialect) for the query catalog.

Each oracle is written independently of the DataFrame code, from the raw
driver tables, so that the pair checks the Spark plan end to end.  The
shared CTE chain below is the SQL statement of the adapter + cleaning +
customer table; each query appends its own SELECT.
"""

from __future__ import annotations


def rnd(expr: str, digits: int) -> str:
    """Half-to-even rounding on the scaled double (matches ``exprs.rnd``)."""
    scale = 10 ** digits
    return f"(round_even(CAST(({expr}) AS DOUBLE) * {scale}.0, 0) / {scale}.0)"


def ratio(num: str, den: str) -> str:
    return f"(CAST(({num}) AS DOUBLE) / CAST(NULLIF(({den}), 0) AS DOUBLE))"


def clip01(expr: str) -> str:
    return f"(CASE WHEN ({expr}) IS NOT NULL THEN greatest(least(({expr}), 1.0), 0.0) END)"


def week_start(expr: str) -> str:
    return f"CAST(date_trunc('week', CAST(({expr}) AS DATE)) AS DATE)"


def first_by(value: str, order: str = "{'d': order_date, 'o': order_id}") -> str:
    return f"arg_min({value}, CASE WHEN {value} IS NOT NULL THEN {order} END)"


BASE_CTES = f"""
li AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_tax, l_shipdate,
         CAST(l_partkey AS VARCHAR) AS product_id,
         CAST(l_quantity AS BIGINT) AS quantity,
         CAST(l_discount AS DECIMAL(4,2)) AS discount,
         ROUND(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS revenue,
         CAST(l_quantity AS BIGINT) % 8 AS cart_additions,
         CAST(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS BIGINT) AS completed_orders,
         l_returnflag AS payment_method
  FROM lineitem
),
li_ranked AS (
  SELECT *, row_number() OVER (
      PARTITION BY l_orderkey, l_linenumber
      ORDER BY product_id, l_suppkey, quantity, l_extendedprice, discount, l_tax, l_shipdate,
               payment_method, completed_orders) AS rn
  FROM li
),
first_order AS (
  SELECT o_custkey, MIN(CAST(o_orderdate AS DATE)) AS first_date
  FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
  GROUP BY o_custkey
),
hdr AS (
  SELECT o.o_orderkey,
         CAST(o.o_custkey AS VARCHAR) AS customer_id,
         c.c_mktsegment AS customer_segment,
         n.n_name AS city,
         CAST(fo.first_date - CAST(c.c_custkey % 30 AS INTEGER) AS DATE) AS customer_signup_date,
         CAST(o.o_orderdate AS DATE) AS order_date,
         o.o_orderpriority AS sales_channel,
         o.o_orderstatus AS order_status
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN first_order fo ON fo.o_custkey = c.c_custkey
),
raw_all AS (
  SELECT CAST(d.l_orderkey AS VARCHAR) || '-' || CAST(d.l_linenumber AS VARCHAR) AS order_id,
         h.order_date, h.customer_id, h.customer_segment, h.customer_signup_date,
         d.product_id, p.p_type AS product_category, p.p_name AS product_name,
         d.quantity, CAST(p.p_retailprice AS DECIMAL(18,2)) AS unit_price, d.discount, d.revenue,
         ROUND(d.revenue * (CAST(18 + p.p_size % 35 AS DECIMAL(4,0)) * 0.01), 2) AS margin,
         h.city, h.sales_channel, p.p_brand AS campaign_name, d.payment_method,
         CAST(p.p_size - 1 AS BIGINT) AS visits, d.cart_additions, d.completed_orders, h.order_status,
         d.l_suppkey, d.l_tax, d.rn
  FROM li_ranked d
  JOIN hdr h ON d.l_orderkey = h.o_orderkey
  JOIN part p ON d.l_partkey = p.p_partkey
),
raw AS (SELECT * EXCLUDE (rn) FROM raw_all WHERE rn = 1),
cl AS (
  SELECT order_id, order_date, customer_id, customer_segment, customer_signup_date,
         product_id, product_category, product_name, quantity, unit_price,
         COALESCE(discount, 0) AS discount, revenue, margin, city, sales_channel, campaign_name,
         payment_method, visits, cart_additions, completed_orders, order_status,
         CAST(year(order_date) AS BIGINT) AS year,
         CAST(month(order_date) AS BIGINT) AS month,
         CAST(week(order_date) AS BIGINT) AS week_number,
         CAST(quarter(order_date) AS BIGINT) AS quarter,
         {week_start('order_date')} AS week_start,
         COALESCE(order_status = 'F', false) AS is_completed,
         {clip01(ratio('completed_orders', 'visits'))} AS conversion_rate,
         {clip01('1.0 - ' + ratio('completed_orders', 'cart_additions'))} AS cart_abandonment_rate
  FROM raw
  WHERE revenue > 0 AND quantity > 0 AND unit_price > 0
    AND COALESCE(discount, 0) BETWEEN 0 AND 1
    AND order_id IS NOT NULL AND customer_id IS NOT NULL AND product_id IS NOT NULL
    AND order_date IS NOT NULL
),
comp AS (SELECT * FROM cl WHERE is_completed),
rfm AS (
  SELECT customer_id,
         max(order_date) AS last_purchase_date,
         CAST(date_diff('day', max(order_date), (SELECT max(order_date) FROM cl)) AS BIGINT)
             AS days_since_last_purchase,
         count(order_id) AS purchase_frequency,
         CAST(sum(revenue) AS DOUBLE) AS total_revenue,
         CAST(sum(revenue) AS DOUBLE) / count(revenue) AS avg_order_value,
         CAST(sum(quantity) AS BIGINT) AS total_units,
         count(order_id) >= 2 AS is_repeat_customer,
         date_diff('day', max(order_date), (SELECT max(order_date) FROM cl)) >= 60 AS is_churned
  FROM comp GROUP BY customer_id
)
"""


def with_base(select: str, extra_ctes: str = "") -> str:
    ctes = BASE_CTES.strip()
    if extra_ctes.strip():
        ctes += ",\n" + extra_ctes.strip()
    return f"WITH {ctes}\n{select.strip()}"


def group_sums(key: str, src: str = "comp") -> str:
    """Aggregates shared by the weekly / campaign / channel / segment marts."""
    return f"""
  SELECT {key},
         sum(revenue) AS _rev, count(revenue) AS _rev_n, count(order_id) AS total_orders,
         CAST(sum(quantity) AS BIGINT) AS total_units, sum(margin) AS _margin,
         count(DISTINCT customer_id) AS unique_customers,
         sum(discount) AS _disc, count(discount) AS _disc_n,
         CAST(sum(visits) AS BIGINT) AS visits, CAST(sum(cart_additions) AS BIGINT) AS cart_additions,
         CAST(sum(completed_orders) AS BIGINT) AS completed_orders
  FROM {src} WHERE {key} IS NOT NULL GROUP BY {key}"""


def repeat_by(key: str) -> str:
    return f"""
  SELECT {key}, count(*) AS repeat_customers
  FROM (SELECT DISTINCT {key}, customer_id FROM comp WHERE {key} IS NOT NULL) p
  WHERE customer_id IN (SELECT customer_id FROM rfm WHERE is_repeat_customer)
  GROUP BY {key}"""


WEEKLY_CTE = f"""
wk_sums AS ({group_sums('week_start')}),
new_c AS (
  SELECT {week_start('customer_signup_date')} AS week_start, count(DISTINCT customer_id) AS new_customers
  FROM cl WHERE customer_signup_date IS NOT NULL GROUP BY 1
),
rep_c AS ({repeat_by('week_start')}),
weekly AS (
  SELECT w.week_start,
         {rnd('CAST(_rev AS DOUBLE)', 2)} AS total_revenue,
         total_orders, total_units,
         {rnd('CAST(_margin AS DOUBLE)', 2)} AS total_margin,
         {rnd('CAST(_rev AS DOUBLE) / _rev_n', 2)} AS avg_order_value,
         unique_customers,
         CAST(_disc AS DOUBLE) / _disc_n AS avg_discount,
         visits, cart_additions, completed_orders,
         {rnd(ratio('_margin', '_rev'), 4)} AS gross_margin_pct,
         {rnd(clip01(ratio('completed_orders', 'visits')), 4)} AS conversion_rate,
         {rnd(clip01('1.0 - ' + ratio('completed_orders', 'cart_additions')), 4)} AS cart_abandonment_rate,
         {rnd(ratio('CAST(_rev AS DOUBLE)', 'lag(CAST(_rev AS DOUBLE)) OVER (ORDER BY w.week_start)') + ' - 1.0', 4)}
             AS revenue_wow_growth,
         {rnd(ratio('total_orders', 'lag(total_orders) OVER (ORDER BY w.week_start)') + ' - 1.0', 4)}
             AS orders_wow_growth,
         COALESCE(n.new_customers, 0) AS new_customers,
         COALESCE(r.repeat_customers, 0) AS repeat_customers
  FROM wk_sums w
  LEFT JOIN new_c n ON n.week_start = w.week_start
  LEFT JOIN rep_c r ON r.week_start = w.week_start
)"""


def performance_sql(dim: str) -> str:
    return with_base(f"""
SELECT {dim},
       CAST(_rev AS DOUBLE) AS total_revenue, total_orders, unique_customers,
       {rnd('CAST(_rev AS DOUBLE) / _rev_n', 2)} AS avg_order_value,
       CAST(_margin AS DOUBLE) AS total_margin,
       CAST(_disc AS DOUBLE) / _disc_n AS avg_discount,
       {rnd(ratio('_margin', '_rev'), 4)} AS gross_margin_pct,
       {rnd(ratio('CAST(_rev AS DOUBLE)', '(SELECT CAST(sum(revenue) AS DOUBLE) FROM comp WHERE ' + dim + ' IS NOT NULL)'), 4)}
           AS revenue_share
FROM g ORDER BY total_revenue DESC, {dim}""", f"g AS ({group_sums(dim)})")


def binary_sum(expr: str) -> str:
    """Sum of DOUBLE values as integers of 2^-40, rounded once at the end."""
    return f"(CAST(sum(CAST(({expr}) * 1099511627776.0 AS HUGEINT)) AS DOUBLE) / 1099511627776.0)"
