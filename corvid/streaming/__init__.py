"""Streaming forms of the batch operators.

The reference jobs are bounded reads only.  The log parse is a per-line
projection and the per-country totals a plain aggregate, so the same
operators run unchanged on a ``readStream`` of log files; nothing here
adds new semantics.
"""
