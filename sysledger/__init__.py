"""sysledger: catalog listings, table sizing, history capture and user sync
as Spark jobs.

    from sysledger import list_tables, table_sizes, merge_upsert, sync_users, Tables, jobs
"""

from .operators.capture import (
    append_rows,
    extract_sessions,
    extract_statements,
    extract_users,
    merge_counts,
    merge_upsert,
    watermark,
)
from .operators.listings import (
    list_functions,
    list_schemas,
    list_sessions_history,
    list_statements_history,
    list_tables,
    list_users_history,
    list_views,
)
from .operators.reports import capture_gaps, inactive_users, long_running, run_gaps, statement_attribution
from .operators.sizing import table_sizes
from .operators.users import set_user_attributes, sync_user_counts, sync_users, sync_users_flagged
from .plans import jobs
from .schemas import SCHEMAS, align_schema
from .sinks.export import export_text
from .sinks.tables import Tables
from .sources.relstats import relation_stats

__all__ = [
    "SCHEMAS", "Tables", "align_schema", "append_rows", "capture_gaps", "export_text", "extract_sessions",
    "extract_statements", "extract_users", "inactive_users", "jobs", "list_functions", "list_schemas",
    "list_sessions_history", "list_statements_history", "list_tables", "list_users_history", "list_views",
    "long_running", "merge_counts", "merge_upsert", "relation_stats", "run_gaps", "set_user_attributes",
    "statement_attribution", "sync_user_counts", "sync_users", "sync_users_flagged", "table_sizes", "watermark",
]
