"""Column expressions and column-name helpers (all JVM-side, no UDFs)."""

from fieldbook.functions.dates import instant_date, text_date
from fieldbook.functions.logic import agree_flag, blank_to, level_or_null, rank_of, recode
from fieldbook.functions.naming import (clean_name_list, clean_names, drop_matching, names_without,
                                        replace_in_name, replace_in_names, snake_name, with_prefix,
                                        with_suffix)
from fieldbook.functions.numbers import round_half_even, signed_count, sum0, to_number
from fieldbook.functions.text import clean_text, padded_id, paste_na, squeeze_first, trim_all

__all__ = [
    "agree_flag", "blank_to", "clean_name_list", "clean_names", "clean_text", "drop_matching",
    "instant_date", "level_or_null", "names_without", "padded_id", "paste_na", "rank_of", "recode",
    "replace_in_name", "replace_in_names", "round_half_even", "signed_count", "snake_name",
    "squeeze_first", "sum0", "text_date", "to_number", "trim_all", "with_prefix", "with_suffix",
]
