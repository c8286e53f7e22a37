"""Column -> Column builders (no actions). IDs refer to the operator inventory."""

from tessera.functions.contacts import extract_emails, extract_phone_numbers
from tessera.functions.convert import (convert, to_array, to_bool, to_datetime_value, to_dict,
                                       to_float, to_int, to_string)
from tessera.functions.dates import format_ntz, parse_date, to_datetime
from tessera.functions.hashing import generate_hash, record_hash
from tessera.functions.sizes import format_file_size
from tessera.functions.structs import merge_maps, redact, redact_json, redact_map
from tessera.functions.text import (clean_string, clean_text, initials, safe_filename, slugify,
                                    split_ws, strip_ws, to_text, word_count)
from tessera.functions.web import extract_domain, normalize_url, url_join, url_part

__all__ = [
    "clean_string", "clean_text", "convert", "extract_domain", "extract_emails",
    "extract_phone_numbers", "format_file_size", "format_ntz", "generate_hash", "initials", "merge_maps",
    "normalize_url", "parse_date", "record_hash", "redact", "redact_json", "redact_map", "safe_filename",
    "slugify", "split_ws", "strip_ws", "to_array", "to_bool", "to_datetime",
    "to_datetime_value", "to_dict", "to_float", "to_int", "to_string", "to_text",
    "url_join", "url_part", "word_count",
]
