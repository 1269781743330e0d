"""lokum — a Spark-native engine for listing capture, normalisation, dedupe,
delta load, embedding and similarity search.

Layout:
  sources/    scans of captured tables, the derived listing view, sinks
  functions/  Column expressions (text, dates, districts, urls, report formats)
  operators/  DataFrame -> DataFrame building blocks (dedupe, delta, filters,
              vector top-k, extraction, embedding, aggregates, paging, report)
  plans/      end-to-end jobs (search, ingest, social posts, export)
  streaming/  Structured Streaming variants of the incremental jobs
"""

__version__ = "0.1.0"
