"""The end-to-end export: search, time range, newest rows, selected and renamed fields."""

from __future__ import annotations

from emberlog.logtable import LogTable
from emberlog.plans.registry import query, table


@query("""
SELECT event_id, ts AS at, value FROM events
WHERE event_type = 'error' AND value > 50 AND ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20'
ORDER BY ts DESC NULLS LAST, event_id LIMIT 20
""")
def export_errors(spark, d):
    events = LogTable(table(spark, d, "events"), time_field="ts", tie_break=("event_id",))
    found = events.search("event_type:error AND value:>50").between("2024-01-10", "2024-01-20")
    return found.export("event_id, ts:at, value", limit=20)
