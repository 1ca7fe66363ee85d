"""tidemark: weekly market signals from daily exchange price files, on Spark.

Layers (each a pure DataFrame -> DataFrame function unless it says it writes):

* ``sources``    landing files, CSV decoding, stock filter, widget payloads, test fixtures
* ``operators``  silver bars and weekly checks, gold signals, serving views,
                 watchlist, expected-file bookkeeping
* ``plans``      the end-to-end batch pipeline and the query registry
* ``streaming``  incremental file ingestion with Structured Streaming
* ``functions``  shared column expressions (rounding, week keys, date helpers)
"""

from tidemark.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
