"""Operators for preparing training data, with their queries (``queries``, ``oracle_sql``).

Nothing else in the package imports this subpackage.
"""
