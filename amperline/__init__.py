"""Analytics for power-grid sensor telemetry on Spark DataFrames and streams."""
