"""marketflow: Spark-native analytics for market price feeds.

Layers (all lazy DataFrame functions):

* ``sources``   – landed payload parsing, raw-table readers, seeds, driver fixtures
* ``functions`` – column expressions (exact decimal rounding, spreads, tax, ages)
* ``operators`` – latest-per-key, write modes, data-quality checks
* ``plans``     – staging models, marts, consumer queries, refresh jobs
* ``streaming`` – Structured Streaming versions of ingest / dedupe / change detection
"""

__version__ = "0.1.0"
