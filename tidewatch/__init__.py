"""Rule-driven analytics on event streams and entity feature snapshots, as Spark DataFrames."""
