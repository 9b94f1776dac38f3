"""Composed jobs: layered tables, model selection, model life cycle."""
