"""visitlens: session and stream analytics on PySpark.

Subpackages: ``sources`` (batch and stream inputs, sinks), ``functions``
(column expressions), ``operators`` (batch operators), ``streaming``
(Structured Streaming jobs), ``plans`` (the registered queries and their
DuckDB oracles). ``session.build_session`` creates a session with the package
defaults; every operator takes and returns lazy DataFrames.
"""

__version__ = "0.1.0"
