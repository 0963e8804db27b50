"""framewright: frame-sequence, artifact and parameter operators on Spark DataFrames."""
