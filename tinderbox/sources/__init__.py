"""Readers for the daily feed files, their catalog and the code dictionaries."""
