"""How the operators combine: shared roll-ups, SQL views and presets, the full run."""
