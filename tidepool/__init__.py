"""tidepool: event-stream analytics written as Spark DataFrame jobs.

Every operator takes and returns DataFrames. Event time travels as ``ts_us``
(epoch microseconds, BIGINT) next to an instant ``ts`` (TIMESTAMP), so results
do not depend on the session time zone.
"""

__version__ = "0.1.0"
