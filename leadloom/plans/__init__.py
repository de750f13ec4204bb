"""The five reports."""

from .centre_fill import centre_fill
from .commission_points import commission_points, commission_rules
from .lead_dashboard import campaign_type_rules, lead_dashboard, pre_screen_label
from .scoring_features import scoring_features, treatment_flags
from .segment_mix import segment_mix, segment_totals

__all__ = [
    "campaign_type_rules",
    "centre_fill",
    "commission_points",
    "commission_rules",
    "lead_dashboard",
    "pre_screen_label",
    "scoring_features",
    "segment_mix",
    "segment_totals",
    "treatment_flags",
]
