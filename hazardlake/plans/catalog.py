"""All registered queries: name -> (query, DuckDB SQL or None)."""

from __future__ import annotations

from hazardlake.plans import early_warning, iot, satellite, serving, social, streams

REGISTRY = {
    **iot.QUERIES,
    **satellite.QUERIES,
    **serving.QUERIES,
    **social.QUERIES,
    **early_warning.QUERIES,
    **streams.QUERIES,
}
