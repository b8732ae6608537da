"""Campaign-attribution analytics on Spark DataFrames.

Subpackages: ``functions`` (column helpers), ``sources`` (landing files, raw
tables, test-data adapters), ``operators`` (fact, panels, refreshes, checks,
job log), ``plans`` (the chain on disk, config runners, registered queries)
and ``streaming`` (incremental file ingest). ``python -m roasty`` runs the
chain and the monitoring from a scheduler.
"""

__version__ = "0.1.0"
