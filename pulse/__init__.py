"""pulse: contributor-health analytics on code-hosting events, built on Spark.

Every operator is a plain ``DataFrame -> DataFrame`` function; only the table
helpers in :mod:`pulse.sources.tables`, the landing code in
:mod:`pulse.sources.ingest` and the jobs in :mod:`pulse.plans.jobs` write.
"""

from datetime import date

# The evaluation date of every registered query. The driver's
# data spans 2024-01-01..2024-01-30, so "today" for the pipeline is the day after.
DEFAULT_AS_OF = date(2024, 1, 31)

__all__ = ["DEFAULT_AS_OF"]
