"""Clickstream analytics on Spark: DataFrame in, DataFrame out, batch and streaming."""
