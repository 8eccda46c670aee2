"""Incremental (Structured Streaming) form of the point summaries.

The surveyed scripts have no streaming operators; this package only runs the
batch lead summary (J1 + X1 + A7/A8) over service-line files as they land,
so a growing inventory does not need full recomputation.
"""
