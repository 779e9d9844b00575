"""Card, customer, branch and loan analytics on Spark DataFrames."""
