"""The row-local stages on a streaming source.

The reference reads fixed files once; nothing in it is stateful over time. What carries over to
Structured Streaming unchanged is the row-local part of the pipeline: sentinel cleaning (B1),
accent stripping (B3), the swapped-year repair (B4), lenient casts (B5), the label map (B6) and
the per-row flags (B12-B15). Dedup, row ids and medians need the whole split and stay batch.
"""

from featurepipe.streaming.files import clean_stream, start_clean_stream

__all__ = ["clean_stream", "start_clean_stream"]
