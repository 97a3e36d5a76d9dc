"""gleaner: content-curation operators on Apache Spark.

Subpackages:

* ``functions``  row-local Column builders (text, signals, time, fixed values)
* ``sources``    feed, page, ledger, queue and response scans
* ``operators``  DataFrame operators (keys, screening, bodies, outcomes,
  packages, prompts, scheduling, outbox)
* ``sinks``      per-batch idempotent writers
* ``streaming``  Structured Streaming jobs (foreachBatch)
* ``plans``      the two batch jobs and the registered driver queries
"""

__version__ = "0.1.0"
