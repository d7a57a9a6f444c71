"""quayside: the first layers of a real-time e-commerce warehouse on Spark.

Every operator is a plain ``DataFrame -> DataFrame`` function that runs the
same on batch and Structured Streaming input. Package layout:

* ``sources``   -- change-log / tracking-log readers, dictionary, rules, sinks
* ``functions`` -- column-level helpers (maps, times, text)
* ``operators`` -- the warehouse steps (cdc filters, lookups, trade joins,
                   traffic split, dimension routing, upserts, word count)
* ``plans``     -- the registered batch queries and their SQL oracles
* ``streaming`` -- Structured Streaming drivers (triggers, checkpoints,
                   keyed state, idempotent micro-batch merges)
"""

from quayside.session import build_session, checkpoint_root

__all__ = ["build_session", "checkpoint_root"]
