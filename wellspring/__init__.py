"""wellspring: water-access survey analytics as Spark DataFrame jobs.

Every public function takes DataFrames and returns a DataFrame; nothing is
collected to the driver except small bounded values (one-row checks, hot-key
lists). Start with ``Survey`` (all jobs as methods) or ``wellspring.plans``.
"""

from wellspring.session import build_session
from wellspring.survey import Survey

__version__ = "0.1.0"
__all__ = ["Survey", "build_session"]
