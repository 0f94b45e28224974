"""Registered queries on the test tables, and the SQL that repeats them."""
