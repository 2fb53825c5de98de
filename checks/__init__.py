"""Registered queries: every operator on the given tables, with its SQL where SQL can say it."""
