"""Rule tables, presets, jobs and the registered queries."""
