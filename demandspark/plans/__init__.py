"""Reporting tables and the registered queries."""
