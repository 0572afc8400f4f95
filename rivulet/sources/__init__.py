from rivulet.sources.schemas import (APPLIANCE_ORDER, COMBINED_ORDER, ELECTRONIC_ORDER,
                                     PROCESSED_ORDER, PRODUCT_ORDER, RECORDS, USER,
                                     RecordSchema, conform, topic_schema)
from rivulet.sources.topics import (decode_checked, decode_value, next_offsets, read_topic,
                                    tag_bad, to_topic_records, with_log_offsets, write_report,
                                    write_topic)

__all__ = ["APPLIANCE_ORDER", "COMBINED_ORDER", "ELECTRONIC_ORDER", "PROCESSED_ORDER",
           "PRODUCT_ORDER", "RECORDS", "USER", "RecordSchema", "conform", "topic_schema",
           "decode_checked", "decode_value", "next_offsets", "read_topic", "tag_bad",
           "to_topic_records", "with_log_offsets", "write_report", "write_topic"]
