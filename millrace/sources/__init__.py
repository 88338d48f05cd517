"""Readers: source trees, record tables and command files."""
