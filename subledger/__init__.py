"""Subscription analytics on Spark.

Typed tables for a subscription business, integrity checks that return
violations as data, and DataFrame operators for growth, revenue,
retention, churn, migration, attribution, corporate seats, value,
forecasting and churn risk.
"""

AS_OF = "2024-02-01"
