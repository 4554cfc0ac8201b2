"""Readers for the company CSV, statement/filing JSON, landed documents and tables."""
