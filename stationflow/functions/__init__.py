from .expressions import *  # noqa: F401,F403
from .expressions import (  # noqa: F401
    all_of,
    day_type,
    dow0,
    hour_label,
    parse_quarter_label,
    quarter_filter,
    quarter_label,
    round_binary,
    station_id_from_label,
    where,
)
