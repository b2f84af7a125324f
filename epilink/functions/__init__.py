"""Column expressions: every function takes columns and returns a column."""

from .numeric import clamp_to_zero, python_round, whole_number
from .records import content_hash, prefixed_id, record_id, with_defaults, with_source
from .temporal import (
    alert_sentence,
    current_week_key,
    epi_week,
    epi_year,
    extract_temporal_key,
    format_week_key,
    iso_text_to_date,
    iso_utc,
    iso_utc_now,
    epoch_seconds_now,
    long_date,
    month_label,
    split_week_key,
    timex_to_week_key,
    week_key,
    with_epi_week_key,
)
from .text import (
    float_text,
    gazetteer_key,
    local_name,
    mint_iri,
    normalize_name,
    python_strip,
    python_title,
    squeeze,
    underscored,
)
