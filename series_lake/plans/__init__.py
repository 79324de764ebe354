"""Whole runs put together from the operators; plain functions for any scheduler."""
