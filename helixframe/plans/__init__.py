"""Logical plans: proxy views over the driver tables, registered queries, oracles."""
