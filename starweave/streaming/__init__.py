"""Incremental (Structured Streaming) driver for the fact load.

The reference loads its fact in full batches only; this package runs the
same key resolution over staging files as they land, with no new semantics.
"""

from starweave.streaming.fact_stream import load_fact_batch, start_fact_stream

__all__ = ["load_fact_batch", "start_fact_stream"]
