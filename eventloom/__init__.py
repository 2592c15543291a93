"""Activity analytics on Spark: hourly event files in, fact tables and metrics out."""
