"""Operators for preparing text corpora; nothing else in the library imports this subpackage."""
