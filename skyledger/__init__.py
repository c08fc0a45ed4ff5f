"""Airline on-time-performance data work as Spark DataFrame operators.

Every operator takes a DataFrame (and column names as keyword defaults) and
returns a DataFrame; the caller owns the session and decides when to act.
"""

__version__ = "0.1.0"
