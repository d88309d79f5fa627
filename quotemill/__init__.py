"""Market time-series analytics as plain DataFrame -> DataFrame functions on Spark."""
