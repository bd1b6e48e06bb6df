"""Training-data pipeline operators.

One module per operator.  Nothing else in the library imports this package;
``queries.py`` collects the registered queries and their DuckDB oracles.
"""
