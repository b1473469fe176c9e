"""fareweave: feature, regression and drift work on PySpark DataFrames."""
