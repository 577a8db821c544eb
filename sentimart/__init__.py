"""sentimart: audience analytics (video comments, sentiment marts) on Spark.

Every operator is a ``DataFrame -> DataFrame`` function planned by
Catalyst; only sinks trigger actions.
"""

__version__ = "0.1.0"
