"""occurra: a Spark-native pipeline for species-occurrence records.

Layers (all DataFrame / SQL built-ins, no Python UDFs):

* ``occurra.sources``    landed-file readers, predicate trees, test-table projections
* ``occurra.functions``  Column -> Column parse / coercion expressions
* ``occurra.operators``  normalisers, upsert, staging, marts, serving, quality checks,
                         incremental windows
* ``occurra.plans``      end-to-end jobs (historical / incremental load, model build + gate)
* ``occurra.streaming``  Structured Streaming variant of the landed-file ingest
"""

from occurra.session import build_session, checkpoint_dir  # noqa: F401

__all__ = ["build_session", "checkpoint_dir"]
