from regiostat.functions.scalars import (  # noqa: F401
    code_prefix, first_token, inf_to_null, lenient_double, lenient_int, map_month,
    quarter_of, round_half_even, season_of, strict_int, tariff_of, year_month_parts,
    zero_pad,
)
from regiostat.functions.names import clean_column_name, clean_headers  # noqa: F401
