"""stationflow: a Spark-native batch analytics library for station-to-station trips.

Layers: ``sources`` (CSV, lake, manifest and archive readers), ``operators``
(dedup, joins, models, dashboard queries, data checks), ``sinks`` (lake,
warehouse tables, exports, manifest), ``plans`` (ingest, warehouse build,
pipeline), ``streaming`` (incremental ingestion of newly arrived files).
"""

__version__ = "0.1.0"
