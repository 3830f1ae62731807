"""ledgerflow: a PySpark-native retail medallion pipeline.

Layers (all lazy DataFrame functions, no driver-side row loops):

* ``sources``   – bronze/silver/gold readers and the driver-table domain adapter
* ``operators`` – cleaning (silver), data-quality checks, gold aggregates,
                  deterministic dedupe and distributed ranking
* ``plans``     – gold SQL models, report queries, run log / catalog, jobs
* ``sinks``     – partitioned writes, keyed upsert, append logs
* ``streaming`` – incremental bronze→silver and daily totals
"""

__all__ = ["session", "schemas"]
