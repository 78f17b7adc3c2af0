from starblend.sources.readers import (
    first_line,
    line_numbers,
    optional_source,
    read_businesses,
    read_checkins,
    read_pairs,
    read_photos,
    read_ratings,
    read_tips,
    read_users,
    with_row_id,
)
from starblend.sources.writers import write_predictions

__all__ = [
    "first_line",
    "line_numbers",
    "optional_source",
    "read_businesses",
    "read_checkins",
    "read_pairs",
    "read_photos",
    "read_ratings",
    "read_tips",
    "read_users",
    "with_row_id",
    "write_predictions",
]
