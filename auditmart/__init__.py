"""auditmart: a PySpark reporting mart over an interview-scheduling audit log.

Layers: ``sources`` (scan / write / staging), ``functions`` (scalar
expressions), ``operators`` (audit filters, measures, ordered counting),
``plans`` (the four reports as lazy DataFrames), ``jobs`` (compute and write
the report tables), ``streaming`` (incremental staging as a Structured
Streaming job).  ``queries`` / ``oracle_sql`` register every operator with an
independent SQL specification.
"""

__version__ = "0.1.0"
