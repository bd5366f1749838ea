"""Commerce analytics on Spark: DataFrame operators and jobs from raw orders and events to business answers."""
