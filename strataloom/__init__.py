"""Statistical operators on population and claims-like tables, built on PySpark DataFrames."""
