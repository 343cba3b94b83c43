"""Registered queries on derived certificate tables, and the SQL they are checked against."""
