"""Incremental runs: hours are processed as their files arrive."""
