"""Queries over the given tables with their ANSI-SQL counterparts."""
