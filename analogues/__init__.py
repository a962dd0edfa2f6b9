"""The given tables seen as merchant and terminal tables, in Spark and in SQL."""
