"""tallyboard: daily usage analytics for collaborative workspaces, on PySpark."""

__version__ = "0.1.0"
