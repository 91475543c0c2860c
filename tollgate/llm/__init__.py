"""Training-data operators: search, near-duplicate removal, mixing, formatting, quality
rules, token files, tokenisation, license scans, line dedup and sharding.

Nothing outside this subpackage imports it, except the guarded registration in
``__spark_entry__.py``.  ``registry.load_all()`` imports the operator modules, which
register their queries and oracle SQL.
"""
