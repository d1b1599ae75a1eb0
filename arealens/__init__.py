"""arealens - population health indicators as lazy Spark plans.

Event-level facts (episodes, deaths, registrations) and area counts become
published indicators: geography roll-up, population join, multi-year
averaging, percentages / crude / age-sex standardised rates with confidence
intervals, deprivation inequality measures and QA checks.  Every operator is a
``DataFrame -> DataFrame`` function built from Spark SQL expressions, joins,
windows and aggregates.
"""

__version__ = "0.1.0"

__all__ = ["IndicatorSpec", "run_indicator", "run_deprivation", "run_jobs", "run_keyed", "get_session"]


def __getattr__(name):
    # lazy re-exports, so importing the package does not start anything
    if name == "IndicatorSpec":
        from .plans.spec import IndicatorSpec
        return IndicatorSpec
    if name == "run_indicator":
        from .plans.indicator import run_indicator
        return run_indicator
    if name == "run_deprivation":
        from .plans.deprivation import run_deprivation
        return run_deprivation
    if name in ("run_jobs", "run_keyed"):
        from .plans import runner
        return getattr(runner, name)
    if name == "get_session":
        from .session import get_session
        return get_session
    raise AttributeError(name)
