"""tidewatch: event and content analytics as plain Spark jobs.

Every operator takes DataFrames and returns a DataFrame; the same functions
are used on batch tables and, where it makes sense, on streams.
"""

__version__ = "0.1.0"
