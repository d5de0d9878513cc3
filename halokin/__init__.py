"""halokin — aperture kinematics of particle snapshots on Spark.

Layout:
  functions/  Column-expression helpers (vector algebra, periodic grid)
  sources/    derived fixtures, CSV/text ingest, Parquet scans and sinks
  operators/  neighbour join, kinematics, aperture sweeps, catalogues, stats
  plans/      end-to-end jobs, the query registry and its SQL oracle
  streaming/  batched, resumable file ingest on Structured Streaming
"""

__version__ = "0.1.0"
