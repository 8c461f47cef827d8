"""The transaction tables: suites of checks, staging, mart, gates and the full cycle."""
