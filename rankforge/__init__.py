"""rankforge: ranking-data pipelines and analytics on Spark DataFrames."""
