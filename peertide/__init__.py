"""Spark-native audience-demand analytics: operators are pure functions over DataFrames."""
