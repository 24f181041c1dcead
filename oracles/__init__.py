"""The same queries as DuckDB SQL, written independently of the Spark operators.

Running measures are theta joins here and event sweeps in the engine; lines are
always read from the full fact table here and from lean joins in the engine.
Money is rounded half up in whole cents, so both sides give the same digits.
"""

from oracles.build import oracle_statements

__all__ = ["oracle_statements"]
