"""Query/product relevance on Spark DataFrames."""
