"""Scalar and aggregate building blocks, all native column expressions."""
