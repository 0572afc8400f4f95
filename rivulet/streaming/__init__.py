"""Structured Streaming: starting queries, stateful operators, sinks."""

from rivulet.streaming.runner import (RetryPolicy, StreamRun, run_stream, run_with_policy,
                                      start_stream, stream_checkpoint, stream_run)
from rivulet.streaming.sinks import (changelog_writer, enrich_latest_writer, error_budget_writer,
                                     has_finished_batch, mark_late_writer, read_table,
                                     receipts_writer, running_sum_writer, start_table, window_writer, write_batch)
from rivulet.streaming.stateful import (StreamFold, budget_stream, enrich_asof_stream, fold_by_key_stream,
                                        fold_stream, mark_late_stream, produce_stream, read_state,
                                        running_sum_stream, tumbling_sum_stream,
                                        window_stream, with_clock_before, with_state_before)

__all__ = [n for n in dir() if not n.startswith("_")]
