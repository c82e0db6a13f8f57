"""Binds the driver's test tables to the roles the reports expect, and registers the queries."""
