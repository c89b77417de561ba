"""Incremental jobs: each drains what has arrived, commits and stops."""
