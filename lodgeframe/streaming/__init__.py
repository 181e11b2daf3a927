"""Structured Streaming wrappers around the batch operators.

The original jobs read only bounded files; the one request-driven path (the
best-price lookup) is offered as a stream of host requests here.
"""

from lodgeframe.streaming.serving import best_price_stream, read_request_stream  # noqa: F401
