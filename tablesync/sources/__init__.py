"""Scans: JDBC tables and queries, or any DataFrame handed in."""
