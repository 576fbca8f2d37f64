"""Executors import this package's task functions, so the driver sends the package to them."""

from holdfast.sources.shipping import ship_package

__all__ = ["ship_package"]
