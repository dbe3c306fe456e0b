from postgrain.functions.columns import (
    account_label,
    engagement,
    location_or_unknown,
    normalize_username,
    per_follower,
    post_type_label,
)
from postgrain.functions.hashing import bit_mask, code_points, djb2, sdbm, wide_hashes
from postgrain.functions.temporal import date_parts, parse_legacy_timestamp, parse_post_timestamp

__all__ = [
    "account_label", "bit_mask", "code_points", "date_parts", "djb2", "engagement",
    "location_or_unknown", "normalize_username", "parse_legacy_timestamp",
    "parse_post_timestamp", "per_follower", "post_type_label", "sdbm", "wide_hashes",
]
