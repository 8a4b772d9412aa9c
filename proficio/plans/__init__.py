"""Dataset pipelines: staging views, marts, report queries, snapshots."""

from proficio.plans.build import Models

__all__ = ["Models"]
