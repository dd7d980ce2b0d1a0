"""Record-level surveillance analytics on PySpark DataFrames."""
