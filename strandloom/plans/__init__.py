"""Stage snapshots: where long plans are cut."""
