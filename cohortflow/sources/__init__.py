"""Readers and writers: CSV, tables, landed batches, literal rows, saved models."""
