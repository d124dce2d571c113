"""Price-basket analytics on Spark: operators that take and return DataFrames."""
