"""Collections at rest."""
