"""What to build: models, mappings, dossier rules, and the scope of a task."""
