"""Run parameters of the catalogue, shared by the queries and their SQL.

Ranges span the whole test data except where cutting a range is what a query shows.
"""

BUILD_TS = "2024-03-01 00:00:00"

# Orders, line items and what is derived from them.
FIRST_DAY, END_DAY = "1995-01-01", "2002-01-01"
# The day from which stored days are written again in the sinks.
FLAG_FROM = "2001-01-01"
PRUNE_FROM, PRUNE_TO = "1996-12-15", "1998-02-10"

# Ranges that cut, all six different, and such that a day more or less of any of them, or a closed
# end made half-open or back, changes the responses on sf0.01 (``tests/test_catalogue.py``).
WINDOW = {
    "open_start": "1996-04-01",
    "open_end": "2000-06-01",
    "queue_start": "1995-12-11",
    "click_queue_start": "1995-12-10",
    "send_start": "1995-06-10",
    "end": "2000-08-14",
}
WHOLE = {
    "open_start": FIRST_DAY,
    "open_end": END_DAY,
    "queue_start": FIRST_DAY,
    "click_queue_start": FIRST_DAY,
    "send_start": FIRST_DAY,
    "end": END_DAY,
}

# The clicks of a short run.
LOOKUP_FROM, LOOKUP_TO = "1995-03-01", "1995-03-08"

# Events.
EVENTS_FIRST_DAY, EVENTS_END_DAY = "2023-12-01", "2024-02-15"
RESPONSES_END_DAY = "2024-02-01"
REFLAG_FROM, DAY_BEFORE_REFLAG = "2024-01-16", "2024-01-15"
# A response window that ends before the run does, within the events.
WINDOW_FIRST_TS, WINDOW_END_TS = "2024-01-05 10:00:00", "2024-01-17 21:30:00"
WINDOW_RUN_END_TS = "2024-01-24 03:15:00"
# Sends moved this many days, stored under an earlier month of their year, and their range.
MOVED_DAYS, STORED_MONTH, MOVED_FROM, MOVED_TO = 60, "02", "2024-03-10", "2024-03-20"
SHIFT_FROM, SHIFT_TO = "2024-01-08", "2024-01-22"
# Buckets of a stored table; in production as many as keep a bucket within a task's memory.
BUCKETS = 8
