"""Workloads over the test tables: staging-shaped stand-ins, queries and their SQL oracles."""
