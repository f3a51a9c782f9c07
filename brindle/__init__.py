"""Table and stream operators on PySpark DataFrames."""
