"""dusklark: a Spark-native engine for hourly clearance-sales data, event logs and their text by-products."""

__version__ = "0.1.0"
