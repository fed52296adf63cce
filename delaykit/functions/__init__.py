"""Column-level helpers: every function returns a built-in ``Column`` expression
(JVM-side, whole-stage-codegen friendly); none of them is a Python UDF."""

from delaykit.functions.timefmt import (  # noqa: F401
    MINUTE_FORMAT, strip_marker, parse_minute_text, format_minute, format_day,
    convert_timezone, minutes_between, date_minus_days, four_hour_ranges,
)
from delaykit.functions.text import (  # noqa: F401
    text_left, text_right, extract_first, url_base, name_filter, flight_url, flight_file_base,
)
from delaykit.functions.status import status_state, status_code_of, outcome  # noqa: F401
