"""Half-hourly station time series on Spark."""
