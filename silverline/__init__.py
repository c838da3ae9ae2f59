"""silverline: clinical CDC analytics on Spark.

Bronze change-data-capture copies of a FHIR server's tables become clean,
typed silver tables and chart tables, all as Spark DataFrame jobs.

Entry points: ``sources.bronze.Bronze`` (read bronze), ``plans.models.Models``
(any model, lazily), ``plans.incremental.refresh_all`` (one scheduled run),
``streaming.ingest.ingest_models`` (micro-batch ingest), ``jobs`` (spark-submit).
"""

__version__ = "0.1.0"
