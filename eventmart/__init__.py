"""eventmart: a Spark-native event lakehouse (see README.md)."""

from eventmart.operators.aggregates import (  # noqa: F401
    daily_activity, duplicate_report, duplicate_summary, first_last_seen, reconcile_counts,
    unknown_values)
from eventmart.operators.dedup import first_per_key, latest_per_key  # noqa: F401
from eventmart.operators.flatten import flatten  # noqa: F401
from eventmart.operators.incremental import after_mark, high_water_mark  # noqa: F401
from eventmart.operators.merge import (  # noqa: F401
    delete_where, merge_insert, replace_where, upsert)
from eventmart.operators.scd2 import snapshot as scd2_snapshot  # noqa: F401
from eventmart.session import build_session, checkpoint_root  # noqa: F401
from eventmart.sinks.export import export_snapshot  # noqa: F401
from eventmart.sinks.table import VersionedTable  # noqa: F401
from eventmart.sources.files import hour_paths, read_events  # noqa: F401
from eventmart.sources.load import check_contract, load_by_name  # noqa: F401
from eventmart.sources.messages import decode, stream_source  # noqa: F401
