"""Registered queries, their DuckDB oracles, staging of derived inputs."""
