"""Customer analytics on Spark: composable operators that take and return DataFrames."""
