"""Column-level cleaners (``Column`` in, ``Column`` out), all native Spark."""

from lakewash.functions.number import decimal_amount, safe_cast
from lakewash.functions.text import (
    clean_boolean, clean_identity_number, clean_phone, file_stem, hash_identifier,
    initcap_text, mask_secret, matches, regex_chain, single_line_text, strip_ordinals,
    text_length, text_prefix, trim_text,
)
from lakewash.functions.time import (
    clamp_dates, clean_timestamp, epoch_text_to_timestamp, epoch_to_timestamp,
    parse_with_pattern, repair_time_string, safe_timestamp, text_to_date,
)

__all__ = [
    "clamp_dates", "clean_boolean", "clean_identity_number", "clean_phone",
    "clean_timestamp", "decimal_amount", "epoch_text_to_timestamp", "epoch_to_timestamp",
    "file_stem", "hash_identifier", "initcap_text", "mask_secret", "matches",
    "parse_with_pattern", "regex_chain", "repair_time_string", "safe_cast",
    "safe_timestamp", "single_line_text", "strip_ordinals", "text_length",
    "text_prefix", "text_to_date", "trim_text",
]
