"""Cohort and KPI queries, one module per program.

Inputs carry the column names of the exports; every run date and period is an
argument.
"""
