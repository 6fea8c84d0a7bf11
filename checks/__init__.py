"""Queries over the shared test tables, with the SQL that must give the same rows."""
