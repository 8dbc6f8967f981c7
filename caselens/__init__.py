"""Service-request SLA analytics expressed as Spark DataFrame transformations."""

from caselens.params import Params, Weights

__all__ = ["Params", "Weights"]
