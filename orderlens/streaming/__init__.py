"""Incremental refresh.

The source model has no streaming operator: its refresh is a re-run of the
batch.  ``refresh`` expresses exactly that with Structured Streaming: a file
stream over the CSV landing folder, triggered ``availableNow``, whose
``foreachBatch`` re-builds the marts from the whole landing folder whenever
new files arrived (keep-first de-duplication and the marts need the full
history, so each refresh recomputes from all files; the stream only decides
*when*, and its checkpoint records which files were already seen).
"""

from orderlens.streaming.refresh import refresh  # noqa: F401
