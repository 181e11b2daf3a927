"""Column -> Column expressions (no Python UDFs)."""

from lodgeframe.functions.geo import (  # noqa: F401
    has_any_key, haversine_m, in_box, poi_category, to_radians,
)
from lodgeframe.functions.parse import (  # noqa: F401
    amenity_items, amenity_list_len, amenity_score, availability_flag, bath_count,
    beds_imputed, contains_flag, exp_to_int, host_days, log_label, month_of, month_text,
    monthly_profit, occupancy, polarity_to_rating, price_drop_first, price_strip,
    round_half_up, to_float, year_of,
)
from lodgeframe.functions.text import (  # noqa: F401
    not_automated, remove_line_breaks, strip_punctuation, whitespace_tokens,
)
