"""Operators that run on streams of landed files, and write their result as versions."""
