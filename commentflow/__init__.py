"""Comment analytics and moderation jobs on PySpark DataFrames."""
