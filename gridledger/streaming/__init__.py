"""Incremental weekly loads."""
