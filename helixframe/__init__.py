"""helixframe: variant warehouse, cohort analytics and federated statistics
expressed as Spark DataFrame / SQL plans."""

__version__ = "0.1.0"
