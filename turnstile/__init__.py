"""turnstile: Spark-native analytics for building access-gate events.

Layers (all DataFrame -> DataFrame, nothing collected on the data path):

* ``sources``   readers for the student CSV, JSON event files, curated Parquet, Kafka
* ``operators`` parse / route, quality checks, the four reports, graph tables, analytics
* ``functions`` column expressions shared by the operators (dates, hours, periods)
* ``sinks``     report / graph / clean-table writers (idempotent overwrite)
* ``streaming`` Structured Streaming ingest (raw log + curated table)
* ``plans``     batch jobs and the registered query catalogue
"""

__version__ = "0.1.0"
