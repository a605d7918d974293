"""flowlens: e-commerce user-behaviour stream analytics on Spark.

Batch operators are plain DataFrame compositions (Catalyst plans them);
streaming forms use Structured Streaming, with ``transformWithState``
processors only where per-key ordered state is the semantics.
"""

__version__ = "0.1.0"
