from rivulet.functions.hashing import log_partition, murmur2
from rivulet.functions.sums import order_free_sum
from rivulet.functions.text import after_first_dash, byte_length, contains, hello, parse_long
from rivulet.functions.time import (as_event_time, as_local_time, duration_micros, interval,
                                    local_time_to_micros, local_time_to_millis,
                                    millis_to_local_time, millis_to_timestamp,
                                    timestamp_to_millis)

__all__ = ["log_partition", "murmur2", "order_free_sum", "after_first_dash", "byte_length", "contains", "hello", "parse_long",
           "as_event_time", "as_local_time", "duration_micros", "interval",
           "local_time_to_micros", "local_time_to_millis", "millis_to_local_time",
           "millis_to_timestamp", "timestamp_to_millis"]
