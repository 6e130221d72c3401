"""Relational, window, incremental, snapshot and quality operators."""
