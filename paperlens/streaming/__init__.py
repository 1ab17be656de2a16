"""Incremental jobs: landed files to the paper table, exactly once per file."""
