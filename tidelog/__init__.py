"""Change-data-capture operators for PySpark: DataFrame in, DataFrame out."""
