from tidemark.functions.casts import blank_to_null, to_amount, to_date, to_text, to_timestamp
from tidemark.functions.keys import nullable_key, scd_id, surrogate_key, versioned_key
from tidemark.functions.masking import (age_bracket, completed_years, mask_email, mask_name,
                                        mask_phone, redact_digits)

__all__ = [
    "age_bracket", "blank_to_null", "completed_years", "mask_email", "mask_name", "mask_phone",
    "nullable_key", "redact_digits", "scd_id", "surrogate_key", "to_amount", "to_date", "to_text",
    "to_timestamp", "versioned_key",
]
