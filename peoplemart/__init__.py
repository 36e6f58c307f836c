"""People analytics on Spark: a star-schema mart, its quality checks and its KPIs."""
