"""Structured Streaming forms of append and change application."""
