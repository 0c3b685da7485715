"""Model-backed steps: the interface and its stand-ins."""

from lectern.models.client import ModelClient, StandIn
from lectern.models.remote import ModelError, RemoteClient

__all__ = ["ModelClient", "ModelError", "RemoteClient", "StandIn"]
