"""Registered queries: views over the given tables, Spark plans and matching SQL."""
