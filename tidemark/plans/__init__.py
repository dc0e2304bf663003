"""Registered queries: a Spark plan and, where SQL can say it, the matching SQL text."""
