"""Incremental load of landed files."""

from cohortgram.streaming.incremental import load_new_files

__all__ = ["load_new_files"]
