"""Commerce lakehouse and payment-risk analytics on Spark DataFrames."""
