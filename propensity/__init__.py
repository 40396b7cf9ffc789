"""Spark-native response-propensity analytics.

Everything here is a DataFrame / SQL / MLlib plan: feature synthesis with
keyed randomness, profiling, rebalancing and splitting, encoding, distributed
training and tuning, run ranking and whole-table scoring.  No operator pulls
row data to the driver.
"""

__all__ = ["session", "schema"]
