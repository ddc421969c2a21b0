"""Fitted, stateless preparation applied to streaming DataFrames."""
