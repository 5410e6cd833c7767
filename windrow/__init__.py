"""windrow: windowed analytics over retail transactions, readings and text lines.

Every transform takes DataFrames and returns DataFrames, so one definition serves batch tables
and Structured Streaming.  Nothing here starts a query except ``windrow.streaming``.
"""
