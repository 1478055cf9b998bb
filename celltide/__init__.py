"""Radio-coverage analytics on Spark: landing files to map-ready indicators."""

from celltide.schemas import Batch, RadioDomain

__all__ = ["Batch", "RadioDomain"]
