"""Readers and writers for text, delimited, JSON, XML and JDBC data."""
