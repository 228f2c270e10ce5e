"""Communication analytics for loan servicing, on Spark DataFrames."""
