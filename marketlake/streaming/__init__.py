"""Incremental file loads.

The reference has no streaming operators (no watermarks, event-time windows
or stateful operators); its loads are batches of files appended to staging
and upserted into the warehouse. ``loads`` runs the same load as a
Structured Streaming query: new CSV files in a landing folder become
micro-batches, each batch is cleaned and upserted into the current snapshot
with the batch operators, and the snapshot is written as a new version.
"""

from marketlake.streaming.loads import start_dimension_load  # noqa: F401
