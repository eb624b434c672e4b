"""Warehouse, cleansing, privacy, serving and reporting jobs.

Every job is a function from DataFrames to a DataFrame. Points in time are
arguments, never the wall clock, so a re-run gives the same rows.
"""
