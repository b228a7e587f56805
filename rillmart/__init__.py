"""rillmart: a layered, real-time commerce warehouse written as Spark DataFrame jobs.

Every operator is a plain function from DataFrames to a DataFrame.  The same
functions serve batch tables and Structured Streaming inputs unless their
docstring says otherwise.
"""

__version__ = "0.1.0"
