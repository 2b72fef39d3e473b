"""Event-time parsing, rendering and differences, all in UTC.

Texts are matched against the exact accepted shape and then cast: the cast alone
would take more (zones, dates without time), and it is several times faster than
parsing by a date pattern. What is no valid moment gives NULL.
"""

from greenwave.functions.constants import EVENT_TIME_FORMAT
from greenwave.functions.numbers import hundredths, ratio_half_up

# Fixed formats: event times have two-digit fields, production times one or two, logged
# times also outer blanks, a blank separator and a fraction of up to six digits.
EVENT_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}\z"
PRODUCED_SHAPE = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}T[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}\z"
LOGGED_SHAPE = (
    r"^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}[ T][0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}([.][0-9]{1,6})?\s*\z"
)


def _parse(text: str, shape: str) -> str:
    return f"CASE WHEN {text} RLIKE r'{shape}' THEN try_cast({text} AS TIMESTAMP) END"


def parse_event_time(text: str) -> str:
    """Strict event time; anything else, a zone suffix or a fraction included, is NULL."""
    return _parse(text, EVENT_SHAPE)


def parse_produced_at(text: str) -> str:
    """Production time at whole seconds."""
    return _parse(text, PRODUCED_SHAPE)


def parse_logged_time(text: str) -> str:
    """Time written by a decision log, in any of its forms."""
    return _parse(text, LOGGED_SHAPE)


def iso_seconds(time: str) -> str:
    return f'date_format({time}, "{EVENT_TIME_FORMAT}")'


def expiry(event_time: str, minutes: str) -> str:
    """``event_time`` plus whole minutes."""
    return f"({event_time} + make_dt_interval(0, 0, {minutes}))"


def elapsed_ms(later: str, earlier: str) -> str:
    """Milliseconds from ``earlier`` to ``later`` at two decimals; -1 if either is unknown."""
    micros = f"unix_micros({later}) - unix_micros({earlier})"
    return f"coalesce({hundredths(ratio_half_up(micros, '10'))}, -1D)"
