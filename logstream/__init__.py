"""logstream: access-log and event-stream analytics on Spark DataFrames.

The same functions work on batch and streaming frames unless noted.
"""

from .functions.parse import (classify_status, parse_access_log, parse_labeled, parse_sparse,
                              parse_vector, status_code, status_text, url_lenient, url_strict,
                              with_status_class)
from .operators.alarm import alarms, error_alarm
from .operators.latest import latest_by_key
from .operators.online_ml import (KMeansState, LinRegState, kmeans_assign, kmeans_score,
                                  kmeans_train_batch, linreg_score, linreg_train_batch,
                                  scale_features)
from .operators.records import to_access_rows, to_clicks, to_requests, to_urls
from .operators.sessions import sessionize
from .operators.sparse import (SparseKMeans, kmeans_assign_sparse, kmeans_train_sparse,
                               linear_score_sparse)
from .operators.windows import (counts_per_interval, rank_counts, sliding_counts,
                                sliding_from_slices, status_runs, status_totals, top_k)
from .session import get_spark, shared_root
from .sources.lines import read_lines, read_statuses, status_texts, with_arrival_time
from .streaming.arrivals import split_late, stamp_arrivals
from .streaming.history import committed_batches, sql_on_states, state_changes, state_history
from .streaming.ring import open_runs, run_windows, sliding_runs_stream
from .streaming.sessions import session_snapshot, sessionize_stream
from .streaming.state import (ClickProgress, KeyedProcess, finish, map_with_state, state_conf,
                              state_of)
from .streaming.windows import (keep_slice_counts, newest_window_top_k, read_sliding_counts,
                                read_status_runs)
from .streaming.sinks import (await_limit, compact_keyed_table, jdbc_append, read_latest,
                              run_batches, running_totals, sql_per_batch, text_batches,
                              to_console, upsert_by_key)

__all__ = [name for name in dir() if not name.startswith("_")]
