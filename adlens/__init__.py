"""adlens: ad-log analytics, user tags and identity resolution on Spark DataFrames.

Main entry points::

    from adlens import (read_raw_log, type_log, read_log, write_log,      # ETL
                        kpi_report, kpi_columns,                          # reports
                        TagContext, row_tags, register_family,            # tags
                        merge_tags, profile_chunks,                       # profiles
                        connected_components, user_key, all_ids)          # identity

Jobs over paths live in ``adlens.plans.jobs``; incremental versions in ``adlens.streaming``.
"""

from adlens.operators.components import connected_components
from adlens.operators.identity import all_ids, user_key
from adlens.operators.kpi import kpi_columns, kpi_report
from adlens.operators.merge import merge_tags, profile_chunks
from adlens.operators.tags import TagContext, register_family, row_tags
from adlens.sources.rawlog import read_raw_log, type_log
from adlens.sources.sinks import read_log, write_log

__version__ = "0.1.0"

__all__ = [
    "TagContext", "all_ids", "connected_components", "kpi_columns", "kpi_report", "merge_tags",
    "profile_chunks", "read_log", "read_raw_log", "register_family", "row_tags", "type_log",
    "user_key", "write_log",
]
