"""Settings with their defaults: one typed object in place of nested files."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class TextConfig:
    remove_urls: bool = True
    remove_html: bool = True
    remove_mentions: bool = True
    lowercase: bool = True
    ticker_min: int = 1
    ticker_max: int = 5
    max_deep_chars: int = 2048


@dataclass(frozen=True)
class SentimentConfig:
    fast_weight: float = 0.3
    deep_weight: float = 0.7
    #: True gives a missing deep score the value 0.5, as the original system did; False lets the tier drop out.
    legacy_default: bool = False
    negation: float = -0.74
    boost: float = 0.293
    alpha: float = 15.0
    decay: float = 0.05
    max_age_hours: int = 72
    source_weights: dict[str, float] = field(default_factory=lambda: {"twitter": 0.30, "reddit": 0.25, "news": 0.40, "other": 0.05})
    min_points: int = 20


@dataclass(frozen=True)
class RuleConfig:
    bar_max_age_hours: int = 48
    bar_skew_minutes: int = 5
    max_change_percent: float = 20.0
    title_min: int = 10
    content_min: int = 50
    news_max_days: int = 30
    comment_min_score: int = 10
    comment_min_comments: int = 5
