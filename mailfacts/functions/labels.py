"""Text clean-up and classification."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
SENTINEL = "NULL"
MASS_MAILER = 8
HOLDOUT = 13
REDPOINT = 9999
CONTROL_PATTERN = "%control%"
MASS_MAILER_IN_SENDS = "mass mailer"
MASS_MAILER_IN_RESPONSES = "massmailer"
REDPOINT_SYSTEM = "redpoint"
OCP_SYSTEM = "ocp"
SFMC_SYSTEM = "sfmc"


def _column(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def null_sentinel(column: Column | str) -> Column:
    """Replace a null or empty string by the text ``NULL``."""
    column = _column(column)
    return F.when(F.length(column) > 0, column).otherwise(F.lit(SENTINEL))


def _piece(column: Column | str, separator: str, index: int) -> Column:
    return F.get(F.split(_column(column), separator), F.lit(index))


def locale_language(locale: Column | str) -> Column:
    """``en`` of ``en-US``."""
    return _piece(locale, "-", 0)


def locale_country(locale: Column | str) -> Column:
    """``US`` of ``en-US``; null where the locale names no country."""
    return _piece(locale, "-", 1)


def bounce_code(category: Column | str) -> Column:
    """Initials of the first two words; null where there are fewer than two."""
    initials = [F.substring(_piece(category, " ", i), 1, 1) for i in (0, 1)]
    return F.concat(*initials)


def is_redpoint(contact_id: Column | str) -> Column:
    """A known, non-zero contact id. Never null."""
    return F.coalesce(_column(contact_id), F.lit(0)) != 0


def effective_source(contact_id: Column | str, source_id: Column | str) -> Column:
    """Source id after the redpoint override, which also hides a holdout source."""
    return F.when(is_redpoint(contact_id), F.lit(REDPOINT)).otherwise(_column(source_id))


def source_system(source_id: Column | str, mass_mailer: str) -> Column:
    """Name of the sending system; sends and responses spell the mass mailer differently."""
    source_id = _column(source_id)
    return (
        F.when(source_id == MASS_MAILER, mass_mailer)
        .when(source_id == REDPOINT, REDPOINT_SYSTEM)
        .otherwise(OCP_SYSTEM)
    )


def holdout_flag(source_id: Column | str) -> Column:
    """Held back instead of sent. Never null."""
    return F.coalesce(_column(source_id) == HOLDOUT, F.lit(False))


def control_flag(channel_name: Column | str) -> Column:
    """Sent through a control channel. Never null."""
    return F.coalesce(_column(channel_name).like(CONTROL_PATTERN), F.lit(False))
