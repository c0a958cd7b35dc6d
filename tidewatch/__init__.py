"""tidewatch: change-event analytics on Spark.

Batch operators live in ``tidewatch.operators``, sources in ``tidewatch.sources``,
column helpers in ``tidewatch.functions``, the published read-side queries in
``tidewatch.plans`` and the continuous jobs in ``tidewatch.streaming``.
"""

from tidewatch.config import Params, DEFAULTS

__all__ = ["Params", "DEFAULTS"]
__version__ = "0.1.0"
