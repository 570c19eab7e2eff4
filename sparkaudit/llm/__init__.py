"""Operators on text corpora; nothing outside this folder imports them."""
