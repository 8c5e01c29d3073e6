"""Brand-equity analytics as plain Spark DataFrame functions over long metric tables."""

from equitrace.spec import RefreshSpec

__all__ = ["RefreshSpec"]
