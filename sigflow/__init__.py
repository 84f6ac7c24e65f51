"""sigflow: sensor-telemetry ingestion and analytics on Spark.

Subpackages: ``sources`` (CSV, topic, table, mapping), ``functions``
(column expressions), ``operators`` (DataFrame -> DataFrame steps),
``streaming`` (producer and subscriber queries), ``plans`` (the registered
queries and their SQL oracles).
"""

__version__ = "0.1.0"
