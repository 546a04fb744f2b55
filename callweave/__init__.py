"""callweave: code-flow analytics on PySpark.

Source trees become event tables, event tables become instrumentation rules,
rules become sharded text files, and the call traces that come back are
analysed in batch or as a stream.
"""
