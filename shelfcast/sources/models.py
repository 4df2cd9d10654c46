"""Model storage: one saved pipeline, or a family of them, one per cluster."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml import PipelineModel


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def cluster_path(root: str, cluster: int) -> str:
    return f"{root.rstrip('/')}/cluster_{cluster}"


def load_models(root: str, clusters: Iterable[int] = range(6)) -> dict[int, PipelineModel]:
    """The models of the given clusters, by cluster id; a missing one raises."""
    return {cluster: load_model(cluster_path(root, cluster)) for cluster in clusters}
