"""Training-data operators: each module holds one operator and, where registered, its query.

Nothing else in the library imports this package.  ``queries.py`` collects the
``opN_*`` queries and their DuckDB SQL; ``corpus_pipeline.py`` at the repository
top chains five of the operators.
"""
