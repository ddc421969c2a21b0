"""Compositions of operators: table builder, models, tuning, run log and jobs."""
