"""visitlens: session analytics on Spark DataFrames.

A saved analysis task (date range plus optional user and behaviour
conditions) is run against an action log: actions are cut to the range,
rolled up to sessions, joined with user attributes, filtered, and reduced
to one statistics row per task (session count and the share of sessions
in each visit-length and step-length bucket).

Sub-packages:

- ``sources``   readers for the action log, user and product dimensions,
                task tables and sinks
- ``functions`` Column-building helpers (strings, dates, rounding, JSON)
- ``operators`` filters, session roll-up, statistics
- ``plans``     complete jobs, one per registered query
- ``llm``       operators of a training-data pipeline (optional)
"""

from visitlens.session import build_session

__all__ = ["build_session"]
