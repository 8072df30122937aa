"""tidecast: time-series forecasting analytics as Spark DataFrames."""
