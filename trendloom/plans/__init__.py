"""Binding to the test tables, registered queries and their SQL."""
