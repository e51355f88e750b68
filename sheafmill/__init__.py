"""sheafmill: documents, tables and search indexes as Spark DataFrames."""
