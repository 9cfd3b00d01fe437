"""Rule presets, the detection run, reports, validation and the table pipeline."""
