"""tidemark — behavioural and dimensional analytics as Spark DataFrame operators.

Every public operator is a plain function ``fn(DataFrame..., params) -> DataFrame``
that only declares a logical plan: no actions, no driver-side loops, no collects.
Catalyst/AQE choose the physical strategy.
"""

__version__ = "0.1.0"
