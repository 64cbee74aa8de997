"""clickpulse: a Spark-native clickstream metrics engine.

Every operator is a ``DataFrame -> DataFrame`` function built from native
Spark expressions, so the same code runs in batch and in Structured
Streaming.  Sub-packages:

* ``sources``   - record sources (Kafka / files); ``fixtures`` renders the
                  test tables as such records
* ``functions`` - Column helpers: strict JSON, value rendering, timestamps,
                  the contract-to-Column compiler
* ``operators`` - validation, dead letters, metrics, producer counters,
                  stream-health operators
* ``plans``     - serving (dashboard) queries and the query registry
* ``streaming`` - the streaming job, the idempotent metrics sink, storage
"""

__version__ = "0.1.0"
