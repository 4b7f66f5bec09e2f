"""Record-to-graph and dossier building on Spark DataFrames and Structured Streaming."""
