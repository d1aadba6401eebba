"""Registered queries and the SQL that they must agree with."""
