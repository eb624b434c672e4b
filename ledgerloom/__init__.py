"""Retail and consumer-credit analytics jobs on PySpark DataFrames."""
