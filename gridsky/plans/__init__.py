"""Whole questions built from the operators: the job's tables and the dashboard."""
