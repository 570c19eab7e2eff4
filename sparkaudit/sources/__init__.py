"""Readers and writers: tables, delimited files, notebooks, notes, scripts."""
