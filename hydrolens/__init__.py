"""Water-telemetry quality, alerting and status marts on Spark DataFrames."""
