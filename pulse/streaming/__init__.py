"""Late-data and state-bound rules.

The reference has no stream processing: events arrive as daily batch tables
and late rows are handled by re-reading a lookback window (L1) while state is
bounded by a rolling window plus partition expiry (L2). Those two rules live
in :mod:`pulse.streaming.windows`; :mod:`pulse.streaming.arrivals` drives the
daily refresh from newly arrived day tables with Structured Streaming's
``availableNow`` trigger, so a missed run is caught up from the checkpoint.
"""
