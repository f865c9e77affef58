"""Queries over the retail tables, each with the SQL that gives the same rows."""
