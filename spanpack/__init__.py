"""spanpack: clinical era construction (condition, drug and dose eras) on Spark.

An era is a maximal span during which a person is continuously exposed to one
thing, allowing a grace period between neighbouring records. Everything is
expressed with DataFrame operators (aggregates, windows, a size-checked
broadcast join) so Catalyst plans and Tungsten executes the whole job.
"""

from spanpack.config import EraConfig, TableNames
from spanpack.operators import *  # noqa: F401,F403
from spanpack.operators import __all__ as _ops

__all__ = ["EraConfig", "TableNames", *_ops]
