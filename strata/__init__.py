"""strata: a Spark-native layered (Bronze / Silver / Gold) analytics library.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark's own
expressions, so Catalyst and adaptive execution plan it; I/O sits at the edges
(``strata.sources`` and ``strata.sinks``). The flow for one logical date is
``strata.plans.medallion.run_medallion``.
"""

__version__ = "0.1.0"

from strata.plans.medallion import MedallionSpec, run_medallion  # noqa: E402,F401
from strata.sources.paged import read_pages, read_paged  # noqa: E402,F401
