"""Column expressions on titles and view counts. All are JVM built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that never reach a key (the space and the
# underscore are among them), the shape of a valid count, the bucket bounds.
KEY_DROPS = ":,.!?\"'()[]{}\\/ -_"
COUNT_PATTERN = "^[0-9]+$"
LOW_BELOW = 10_000
MEDIUM_BELOW = 100_000


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def title_key(title: Column | str) -> Column:
    """Lower-cased title without ASCII punctuation, spaces and underscores.

    Other characters (tabs, dashes beyond ASCII, typographic quotes) stay, and a
    title of punctuation only becomes the empty string. Idempotent.
    """
    return F.translate(F.lower(_column(title)), KEY_DROPS, "")


def is_view_count(views: Column | str) -> Column:
    """True for a run of ASCII digits; NULL for NULL."""
    return _column(views).rlike(COUNT_PATTERN)


def counted_views(views: Column | str) -> Column:
    """The count as a long, NULL where it does not fit one."""
    return _column(views).try_cast("bigint")


def popularity_bucket(views: Column | str) -> Column:
    """low / medium / high. A NULL count is `high`, as no bound holds for it."""
    n = _column(views).try_cast("bigint")
    return (
        F.when(n < LOW_BELOW, "low")
        .when(n < MEDIUM_BELOW, "medium")
        .otherwise("high")
    )
