from signalwatch.functions.dates import (  # noqa: F401
    month_label, month_start, months_apart, parse_date_any, third_last_day,
)
from signalwatch.functions.labels import outcome_label  # noqa: F401
from signalwatch.functions.rounding import round_half_even, round_to_step  # noqa: F401
from signalwatch.functions.text import english_list, sorted_join  # noqa: F401
