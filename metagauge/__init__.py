"""Open-data metadata quality on Spark."""
