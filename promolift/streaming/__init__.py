"""Streaming.

The modelled pipeline is batch only: it has no streams, watermarks, windows over
event time or keyed state.  The nearest concepts -- late deliveries (T5) and the
gap-based campaign count (W5) -- are batch operators in ``operators``.  Nothing is
built here.
"""
