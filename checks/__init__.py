"""Registered queries over the driver tables, and the same queries in DuckDB SQL."""
