"""Masking that leaves its mapping behind."""

from __future__ import annotations

from pyspark.sql import DataFrame

from maskmetrics.operators.pii import Anonymized, anonymize
from maskmetrics.operators.registry import Registry, registry_stats
from maskmetrics.sources.mapping_store import MappingStore


def anonymize_and_save(df: DataFrame, column: str, doc_key: str, registry: Registry, store: MappingStore,
                       session_id: str, **options) -> Anonymized:
    """Both passes, then the mapping with the tokens they made and one row of stats."""
    done = anonymize(df, column, doc_key, registry, **options)
    store.save(done.mapping, registry_stats(registry, done.tokens.df if done.tokens else None), session_id)
    return done
