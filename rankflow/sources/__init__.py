"""Sources: parquet tables, domain projections and the interaction stream."""

from .tables import (  # noqa: F401
    AS_OF,
    content,
    content_from_parts,
    dirty_interactions,
    exposure_items,
    interactions,
    interactions_from_events,
    operations_log,
    outcome_events,
    profile_maps,
    profile_preferences,
    profiles,
    table,
    user_accounts,
    users,
)
