"""DataFrame operators: log parsing, payloads, table changes, quality checks, joins, views, sinks."""

from tracelake.operators.joins import left_join
from tracelake.operators.logparse import log_rejects, parse_log_lines, with_event_time
from tracelake.operators.payload import as_topic_messages, decode, decode_verdicts, encode, encode_each, split_verdicts
from tracelake.operators.quality import audit_changes, fetch_users, op_log_entry, update_with_audit, validate
from tracelake.operators.tableops import assign_ids, count_rows, delete, exists, insert, page, top, update, upsert

__all__ = [
    "left_join", "log_rejects", "parse_log_lines", "with_event_time", "as_topic_messages", "decode",
    "decode_verdicts", "encode", "encode_each", "split_verdicts", "audit_changes", "fetch_users", "op_log_entry",
    "update_with_audit", "validate", "assign_ids", "count_rows", "delete", "exists", "insert", "page", "top",
    "update", "upsert",
]
