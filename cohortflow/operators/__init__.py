"""Operators: rules, joins, ranks, statistics, imputation, features, folds, metrics, models."""
