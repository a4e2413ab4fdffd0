"""plume: review analytics and a daily business warehouse as Spark jobs.

Public modules:

* ``plume.operators`` — ingest, transform, analysis, stats, quality, feeds
* ``plume.operators.warehouse`` — upstream sources, sessions, warehouse models
* ``plume.sources`` — driver tables, readers/writers, fixtures, written-once tables
* ``plume.streaming`` — Structured Streaming ingestion, windows, dedup
* ``plume.plans`` — end-to-end jobs, registered queries and their oracle SQL
* ``plume.session`` — session defaults and the shared checkpoint folder
"""
