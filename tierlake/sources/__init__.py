"""Scans: relational tables over JDBC and document collections."""
