"""Fixed values.

These values must equal the source model's for the results to match.  They
are stated here once, in plain form, and imported by the operators.
"""

# --- business rules ---------------------------------------------------------
CHURN_INACTIVE_DAYS = 60          # inactive this many days -> churned
REPEAT_MIN_ORDERS = 2             # completed orders needed to be a repeat customer
COMPLETED_STATUS = "Completed"    # order status that counts as completed
DIM_DATE_BUFFER_DAYS = 42         # date dimension runs 6 weeks past the last order
ROLLING_WINDOW_ROWS = 4           # trailing product-week mean

# --- models -----------------------------------------------------------------
RANDOM_SEED = 42
TEST_WEEKS = 8                    # temporal hold-out of the forecast
FORECAST_HORIZON = 4              # weeks forecast ahead
LAGS = (1, 2, 4)
FOREST_TREES = 200
FOREST_DEPTH = 8
GBT_ITERS = 200
GBT_STEP = 0.05
GBT_DEPTH = 4
CHURN_FOREST_TREES = 150
CHURN_FOREST_DEPTH = 6
LOGREG_ITERS = 500
CHURN_TEST_SHARE = 0.25
DEMAND_TEST_SHARE = 0.20
CLASS_THRESHOLD = 0.5

# --- labels -----------------------------------------------------------------
# churn risk: right-closed bins (-0.01, 0.33] (0.33, 0.66] (0.66, 1.01]
RISK_BIN_EDGES = (-0.01, 0.33, 0.66, 1.01)
RISK_LEVELS = ("Low", "Medium", "High")
# demand trend: recent / prior > 1.05 Increasing, < 0.95 Decreasing, else Stable
TREND_UP = 1.05
TREND_DOWN = 0.95
TREND_LABELS = ("Increasing", "Decreasing", "Stable")

# --- reports ----------------------------------------------------------------
TOP_PRODUCTS = 20
EXPECTED_TABLES = (
    "fact_orders", "dim_customers", "dim_products", "dim_date",
    "weekly_kpis", "campaign_performance",
    "sales_channel_performance", "segment_performance",
    "sales_forecast", "customer_churn_risk",
    "product_demand_predictions", "model_performance",
)

# --- measure display formats (semantic model) --------------------------------
MEASURE_FORMATS = {
    "total_revenue": "£#,0.00",
    "total_orders": "#,0",
    "average_order_value": "£#,0.00",
    "units_sold": "#,0",
    "gross_margin": "£#,0.00",
    "gross_margin_pct": "0.00%",
    "active_customers": "#,0",
    "new_customers": "#,0",
    "repeat_customers": "#,0",
    "repeat_customer_rate": "0.00%",
    "conversion_rate": "0.00%",
    "cart_abandonment_rate": "0.00%",
    "wow_revenue_growth": "+0.00%;-0.00%;0.00%",
    "wow_orders_growth": "+0.00%;-0.00%;0.00%",
    "predicted_revenue": "£#,0.00",
    "forecast_error_pct": "0.00%",
    "high_risk_customers": "#,0",
    "churn_risk_rate": "0.00%",
    "increasing_demand_categories": "#,0",
}

# Fields of a raw CSV that count as missing, in every column.
MISSING_WORDS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
                 "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

# Model features in the order the models see them.
FORECAST_FEATURES = ("week_num", "month", "quarter", "t",
                     "revenue_lag1", "revenue_lag2", "revenue_lag4",
                     "orders_lag1", "orders_lag2", "orders_lag4",
                     "revenue_roll4", "avg_disc", "n_customers")
CHURN_FEATURES = ("days_since_last_purchase", "purchase_frequency",
                  "total_revenue", "avg_order_value", "segment_enc")
DEMAND_FEATURES = ("cat_enc", "week_num", "month", "t",
                   "units_lag1", "units_lag2", "units_lag4", "units_roll4")

# Columns of the fact table.
FACT_COLUMNS = (
    "order_id", "order_date", "week_start", "year", "month",
    "week_number", "quarter", "customer_id", "customer_segment",
    "product_id", "product_category", "product_name",
    "quantity", "unit_price", "discount", "revenue", "margin",
    "city", "sales_channel", "campaign_name",
    "visits", "cart_additions", "completed_orders",
    "payment_method", "order_status", "is_completed",
    "conversion_rate", "cart_abandonment_rate",
)
