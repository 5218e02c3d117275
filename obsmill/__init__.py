"""obsmill: concept-keyed observation processing on PySpark DataFrames."""
