from macrotide.functions.bands import (
    correlation_strength,
    health_score,
    inflation_category,
    inflation_delta,
    real_wage,
    wage_inflation_relationship,
)
from macrotide.functions.country import CountryLookup, is_iso3_shaped
from macrotide.functions.formatting import money_text, percent_text
from macrotide.functions.parsing import (
    nan_to_null,
    parse_date,
    parse_number,
    parse_year,
    strip,
    strip_punctuation,
)
from macrotide.functions.percent import load_time_rate, normalize_percentage

__all__ = [
    "CountryLookup", "correlation_strength", "health_score", "inflation_category",
    "inflation_delta", "is_iso3_shaped", "load_time_rate", "money_text", "nan_to_null",
    "normalize_percentage", "parse_date", "parse_number", "parse_year", "percent_text",
    "real_wage", "strip", "strip_punctuation", "wage_inflation_relationship",
]
