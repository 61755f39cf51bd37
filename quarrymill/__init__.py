"""Land, model and check analytics tables with plain Spark DataFrames."""
