"""Event-time text rules as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ISO-8601 forms that Python's ``datetime.fromisoformat`` (after the
# Z -> +00:00 rewrite) accepts and Spark can turn into a timestamp.  Spark alone
# also accepts "2026-09", "2026" and bare times, which Python rejects.  Python
# alone accepts basic dates ("20260918T100000"), week dates, offsets beyond
# 18 hours or with fractions, and any separator; those cannot produce an event
# time here and are rejected too.
ISO_EVENT_TIME = (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
                  r"([T ][0-9]{2}(:[0-9]{2}(:[0-9]{2}([.,][0-9]+)?)?)?"
                  r"(Z|[+-][0-9]{2}(:[0-9]{2}(:[0-9]{2})?|[0-9]{2}([0-9]{2})?)?)?)?$")

# RFC 3339 date-time (JSON-Schema "date-time" format).
RFC3339 = (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?"
           r"([Zz]|[+-][0-9]{2}:[0-9]{2})$")


def event_time(text: Column) -> Column:
    """TIMESTAMP of an event-time text, null when it is not accepted.

    ``try_cast`` rather than ``cast``: with ANSI mode on, a bad value must
    become null, not fail the task.  The cast wants seconds before an offset
    and a point before the fraction, so a text that it refuses is tried again
    with these filled in.
    """
    full = F.translate(text, ",", ".")
    full = F.regexp_replace(full, r"^(.{10}.[0-9]{2})(Z|[+-].*)$", "$1:00$2")
    full = F.regexp_replace(full, r"^(.{10}.[0-9]{2}:[0-9]{2})(Z|[+-].*)$", "$1:00$2")
    return F.when(text.rlike(ISO_EVENT_TIME), F.coalesce(text.try_cast("timestamp"), full.try_cast("timestamp")))


def is_event_time(text: Column) -> Column:
    return event_time(text).isNotNull()


def is_rfc3339(text: Column) -> Column:
    return text.rlike(RFC3339) & F.upper(text).try_cast("timestamp").isNotNull()
