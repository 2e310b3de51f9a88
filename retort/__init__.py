"""retort: compound-data analytics on Spark DataFrames.

Every operator is a ``DataFrame -> DataFrame`` (or ``Column -> Column``)
function built from Spark built-ins, so it composes with
``DataFrame.transform`` and lets Catalyst plan the whole job.
"""

__version__ = "0.1.0"
