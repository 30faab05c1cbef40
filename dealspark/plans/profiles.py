"""Scoring rule sets.

The reference computes "the same" customer scores with four different rule
sets. They are one parameter object here; operators take a profile instead
of inline constants.
"""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class ScoringProfile:
    name: str
    # lead score = revenue/revenue_unit*revenue_points + n*interaction_points
    #              + engagement*engagement_points + win*win_points
    revenue_unit: float = 100_000.0
    revenue_points: float = 30.0
    interaction_points: float = 2.0
    engagement_points: float = 1.0
    win_points: float = 20.0
    score_cap: float | None = 100.0
    score_floor: float | None = None
    # engagement = (pos*positive_points + n*interaction_weight - neg*negative_points) / (n+1)
    positive_points: int = 10
    interaction_weight: int = 2
    negative_points: int = 5
    rounded: bool = True            # round engagement (2), rates (4), score (2)
    # quality bands: (label, threshold) from the top; "left" = score >= t,
    # "right" = pandas.cut style (lower, upper] with 0 outside every band.
    bands: tuple[tuple[str, float], ...] = (("hot", 80.0), ("warm", 60.0), ("cool", 40.0))
    lowest_band: str = "cold"
    band_closed: str = "left"
    band_upper: float = 100.0
    # which deals count as revenue: ("closed_won",) or None for every deal
    revenue_statuses: tuple[str, ...] | None = ("closed_won",)
    channel_column: str = "channel_standardized"
    # probability_to_convert = engagement/100*p_engagement + conversion*p_conversion
    p_engagement: float = 0.4
    p_conversion: float = 0.6
    smoothing: float = 0.001
    # doc_weighted: revenue and interactions are divided by their table
    # maxima and scaled to 100, win rate is scaled to 100 (see
    # features.score_features); lead_score is then rounded to 2 decimals.
    normalize_by_max: bool = False

    def with_(self, **kw) -> "ScoringProfile":
        return replace(self, **kw)


# The weights, caps and bands of the reference's rule sets.
NOTEBOOK = ScoringProfile(name="notebook")
EDA = ScoringProfile(
    name="eda",
    engagement_points=25.0,
    score_floor=0.0,
    rounded=False,
    band_closed="right",
    revenue_statuses=None,
    channel_column="channel",
)
DOC_FLOW = ScoringProfile(name="doc_flow", engagement_points=25.0, score_cap=None, rounded=False)
# doc_weighted: 0.30*rev/max(rev)*100 + 0.20*n/max(n)*100 + 0.25*eng + 0.25*win*100
DOC_WEIGHTED = ScoringProfile(
    name="doc_weighted",
    revenue_points=0.30,
    interaction_points=0.20,
    engagement_points=0.25,
    win_points=0.25,
    score_cap=None,
    normalize_by_max=True,
)

PROFILES = {p.name: p for p in (NOTEBOOK, EDA, DOC_FLOW, DOC_WEIGHTED)}
