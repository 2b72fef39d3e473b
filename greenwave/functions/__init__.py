"""Scalar functions. Those that compute take and return SQL expression text.

Text composes inside ``selectExpr`` and ``expr``, keeps every rule a native
expression, and costs one call to the JVM however long the rule is.
"""

from greenwave.functions.constants import *  # noqa: F401,F403
from greenwave.functions.numbers import (  # noqa: F401
    FIXED_UNIT,
    beyond_fixed,
    hundredths,
    plain_decimal,
    ratio_half_up,
    to_fixed,
)
from greenwave.functions.rules import (  # noqa: F401
    SignalRules,
    density_class,
    green_seconds,
    hour_band,
    hour_factor,
    literal,
    lookup,
    mode_label,
    mode_symbol,
    or_default,
    severity_rank,
    severity_symbol,
    traffic_mode,
)
from greenwave.functions.times import (  # noqa: F401
    elapsed_ms,
    expiry,
    iso_seconds,
    parse_event_time,
    parse_logged_time,
    parse_produced_at,
)
