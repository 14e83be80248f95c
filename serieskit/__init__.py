"""Time-series and panel analytics on PySpark DataFrames."""
