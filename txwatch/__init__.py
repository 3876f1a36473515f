"""txwatch: transaction-monitoring analytics as plain Spark DataFrame functions.

Layers: ``sources`` (readers, test-data adapters), ``functions`` (column
expressions), ``operators`` (DataFrame -> DataFrame steps), ``plans``
(the layered pipeline, sinks, audit), ``streaming`` (Structured Streaming
variants). Every public function takes and returns DataFrames; none holds
a global session.
"""

__version__ = "0.1.0"
