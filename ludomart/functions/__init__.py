from ludomart.functions.dates import calendar, parse_dmy, parse_iso, parse_rfc822
from ludomart.functions.text import clean_name, join_list, lenient_int, primary_name

__all__ = [
    "calendar",
    "clean_name",
    "join_list",
    "lenient_int",
    "parse_dmy",
    "parse_iso",
    "parse_rfc822",
    "primary_name",
]
