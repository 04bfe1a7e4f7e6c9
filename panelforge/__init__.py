"""panelforge: Spark operators for entity x period panel analytics."""

__version__ = "0.1.0"
