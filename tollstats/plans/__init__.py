"""User-facing plans: load, reports, features and model comparison."""
