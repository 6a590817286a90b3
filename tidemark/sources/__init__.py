"""Typed model tables, inline row sets and the landing area."""
