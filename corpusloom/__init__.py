"""corpusloom: a Spark-native analytics engine for time-stamped text corpora.

Everything is ``DataFrame -> DataFrame`` or ``Column -> Column``.  The core never
imports the ``llm`` subpackage, which can be deleted without breaking the rest.
"""

__version__ = "0.1.0"
