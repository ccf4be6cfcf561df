"""Whole runs composed from the operators."""

from bitextloom.plans.filter_corpus import filter_corpus
from bitextloom.plans.profile_corpus import Profile, profile_corpus, profile_frame
from bitextloom.plans.translate_corpus import (
    TranslationSettings,
    translate_corpus,
    translate_pending,
    translation_progress,
    translation_status,
    translator,
)
from bitextloom.sinks.parquet import reshard_for_publish as publish_corpus

__all__ = [
    "Profile",
    "TranslationSettings",
    "filter_corpus",
    "profile_corpus",
    "profile_frame",
    "publish_corpus",
    "translate_corpus",
    "translate_pending",
    "translation_progress",
    "translation_status",
    "translator",
]
