"""lexweave: text-corpus analytics on Spark DataFrames."""
