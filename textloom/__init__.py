"""textloom: a batch text-and-graph analytics engine on Spark DataFrames."""
