"""Registered queries: the jobs bound to the given tables, with oracle SQL."""
