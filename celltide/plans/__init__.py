"""Whole runs over one hour or many, and the registered queries."""
