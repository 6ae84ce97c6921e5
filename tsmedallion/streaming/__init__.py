"""Incremental forms of the silver and gold steps."""
