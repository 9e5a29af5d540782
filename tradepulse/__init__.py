"""Intraday brokerage activity metrics as plain PySpark DataFrame functions."""
