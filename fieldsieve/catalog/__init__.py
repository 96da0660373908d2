"""The registered queries, grouped like the operators they exercise."""

from __future__ import annotations

from . import evaluation, labelling, samples, sinks, sources, streams, urls
from .registry import Query, registered


def all_queries() -> dict[str, Query]:
    return registered()


__all__ = ["all_queries", "evaluation", "labelling", "samples", "sinks", "sources", "streams", "urls"]
