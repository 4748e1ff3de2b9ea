"""The query catalogue: importing this module registers every query."""

from __future__ import annotations

from oddsframe.plans import q_core, q_eval, q_features, q_fit, q_history, q_learn, q_market, q_models  # noqa: F401
from oddsframe.plans import registry
from oddsframe.plans.registry import ORACLES  # noqa: F401
from oddsframe.session import configure



def _place(query) -> tuple:
    """Scans and market features first, then queries without team history, then those with it, then those without an
    SQL text: a comparison that runs out of time has seen the cheap ones."""
    name, builder = query
    text = ORACLES.get(name)
    return text is None, "tlv" in (text or ""), builder.__module__ not in (q_core.__name__, q_market.__name__)


QUERIES = dict(sorted(registry.QUERIES.items(), key=_place))


def flagship(spark, sf_dir):
    configure(spark)
    return QUERIES["prediction_output"](spark, sf_dir)
