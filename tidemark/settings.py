"""Names and values shared with the systems this engine reads from and reports to."""

# They must equal what producers, stored tables and reports use.
COMPLETED = "Completed"
CAPTURE_SERVER = "demo_db_master"
CAPTURE_DATABASE = "demo"
CAPTURE_TABLES = ("products", "orders", "order_items")
METRICS_TOPIC = "daily_sales_metrics"
FIRST_MARK = "2024-01-01 00:00:00"
WATERMARK_DELAY = "10 seconds"
TRIGGER_INTERVAL = "60 seconds"

# Statuses an order may carry. Only "Completed" matters to the metrics; the list
# feeds the allowed-value check.
ORDER_STATUSES = ("Pending", COMPLETED, "Cancelled")
