"""Customer-360 and transaction-risk analytics on Spark DataFrames."""
