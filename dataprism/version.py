"""Library version and integration name stamped into profile metadata."""

__version__ = "0.1.0"
INTEGRATION_NAME = "spark"
