"""Composable PySpark transforms for case triage and policy retrieval.

Every transform takes and returns DataFrames, so a job is an ordinary lazy
plan that Catalyst optimises end to end.
"""
