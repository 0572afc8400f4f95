from rivulet.operators.aggregates import fold_by_key, keyed_sum, running_sum
from rivulet.operators.folds import Fold, fold_keys, fold_updates, rising_run
from rivulet.operators.joins import (asof_resolve, asof_union, combine_orders, enrich_asof,
                                     enrich_latest, interval_join)
from rivulet.operators.quality import (ErrorBudgetExceeded, check_error_budget, error_budget,
                                       quarantine_non_numeric, split_malformed, split_oversize)
from rivulet.operators.scan import DEFAULT_ROWS_PER_CHUNK, running, with_hot_key_chunks
from rivulet.operators.stateless import (filter_contains, filter_numeric_gt, hello_values,
                                         order_number_chain, rekey, tap, unwindow_key,
                                         value_after_dash)
from rivulet.operators.tables import (table_filter, table_from_topic, table_map_values,
                                      table_order_changelog, table_snapshot, table_to_changelog)
from rivulet.operators.windows import (drop_late, late_records, mark_late, stream_time,
                                       tumbling_sum, tumbling_sum_final, tumbling_sum_updates,
                                       window_start, with_event_time)

__all__ = [n for n in dir() if not n.startswith("_")]
