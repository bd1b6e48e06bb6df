"""saltkv: salted row-key tables on Spark.

Delimited batches in; a table partitioned by salt and sorted by row key out;
point, composite, range and batch lookups with newest-load-wins reads.
"""

from .functions.keys import (
    add_row_keys,
    java_string_hash,
    java_string_hash_py,
    next_prefix,
    prefix_py,
    query_key,
    row_key_py,
    salt_width,
)
from .operators.cells import from_cells, to_cells
from .operators.layout import cluster_for_write, dedup_in_load, partition_by_salt, rank_within_salt, sort_within
from .operators.lookup import (
    batch_envelope,
    batch_lookup,
    lookup,
    lookup_response,
    project_fields,
    scan_limit,
    scan_prefix,
    scan_range,
)
from .operators.merge import latest_wins
from .operators.bucketed import batch_lookup_bucketed, bucket_table, lookup_bucketed
from .operators.ranges import scan_ranges
from .plans.job import load_batch, load_rows, upsert_table
from .session import checkpoint_root, get_session, scratch_path
from .sources.delimited import read_batch, write_delimited
from .sources.spec import CHECK_FIELDS, OPINION_FIELDS, TableSpec, load_spec
from .sources.merged import merged, upsert_loads
from .sources.store import create_table, current, list_tables, publish_load, read_loads, stage_load

__all__ = [n for n in dir() if not n.startswith("_")]
