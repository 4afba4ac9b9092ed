"""Operators for preparing training data for language models.

Thirteen operators, one module each, plus ``queries`` (what ``__spark_entry__``
registers) and ``oracle_sql``.  Nothing outside this package imports it.
"""
