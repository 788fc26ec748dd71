"""tessera: retail-sales cleaning, statistics, marts and forecasting as Spark jobs.

Every operator takes and returns a DataFrame (or a small dict of DataFrames);
the work is declared with the DataFrame / SQL API so Catalyst plans it.
"""

__version__ = "0.1.0"
