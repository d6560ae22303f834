"""Demonstration queries over the star-schema test tables, each with SQL for an independent check."""
