"""Readers that turn files or raw text columns into the library's tables, and the table sink."""
