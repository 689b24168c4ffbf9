from .names import q, quoted, dtypes, is_numeric, columns_of
from .scalar import (NA_TOKENS, numeric, classify_value, class_of, is_inf, safe_name, bucket_ratio,
                     direction, explain_text, contains_text, any_null, half_even)
from .digest import DIGEST, digest_columns
from .ordering import order_hash, hash_cell, cell_digits, CELLS

__all__ = ["q", "quoted", "dtypes", "is_numeric", "columns_of", "NA_TOKENS", "numeric", "classify_value",
           "class_of", "is_inf", "safe_name", "bucket_ratio", "direction", "explain_text", "contains_text",
           "any_null", "half_even", "order_hash", "hash_cell", "cell_digits",
           "CELLS", "DIGEST", "digest_columns"]
