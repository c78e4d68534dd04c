"""Readers: files, relational databases, rows in memory."""
