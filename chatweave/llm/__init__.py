"""Operators for preparing training corpora: one module each, queries in ``catalog``."""
