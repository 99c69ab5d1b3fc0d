"""Operators for preparing training data: encoding, sharding, deduplication, extraction, scoring.

Nothing outside this subpackage imports it.
"""
