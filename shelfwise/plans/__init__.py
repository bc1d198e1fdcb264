"""Pipelines (cleaning, features, full run), the run report, and the
bindings that map the driver's tables onto the catalogue roles."""
