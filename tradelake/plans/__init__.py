"""Warehouse models and jobs."""
