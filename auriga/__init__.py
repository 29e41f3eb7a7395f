"""Decision tables, audit rules, forecasts and retrieval as Spark DataFrame jobs."""
