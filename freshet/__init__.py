"""Incremental text enrichment as Spark jobs.

Everything takes DataFrames and returns lazy DataFrames; only the job driver
(`freshet.plans.jobs`), the sinks and the emptiness checks start Spark jobs.
"""

from freshet.plans.jobs import Job, Summary, run_job
from freshet.sinks.target import Target
from freshet.sources.scan import Source

__all__ = ["Job", "Source", "Summary", "Target", "run_job"]
