"""Supply-chain analytics on Spark: masters, metrics, targets, forecasts, quality checks and risk models."""
