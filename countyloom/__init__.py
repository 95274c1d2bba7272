"""Loan-record panels on Spark: ingest, canonical rows, geography, panels, checks and exports."""
