"""stallmark: retail analytics and training-data operators on PySpark DataFrames."""
