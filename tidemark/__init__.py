"""Point-in-time features and decision audits as Spark plans.

``sources``    readers, writers and the adapters for the driver tables
``functions``  column expressions (text, hashed draws)
``operators``  contracts, point-in-time features, sweeps, metrics, policies, splits, model
``plans``      multi-step jobs built from the operators, and the packaged SQL
"""
