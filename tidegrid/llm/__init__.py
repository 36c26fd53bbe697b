"""Training-data operators: ten dealt operators and the corpus pipeline's parts.

Nothing outside this subpackage imports it.  Each ``opN_*`` module holds one
operator with a general interface; ``queries.py`` holds the thin registered
queries and ``oracles.py`` their DuckDB SQL where SQL can express them.
"""
