"""Event, change-data and metrics engine on PySpark."""
