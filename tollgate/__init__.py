"""tollgate: milestone-cascade analytics on Spark.

Entities with an anchor time, a log of follow-up step events and a day window per
expected step -> which steps were completed in time -> cohort statistics, leakage-safe
features, Spark ML models, availability audit and batch / streaming scoring.

Main entry points::

    from tollgate.spec import CascadeSpec, StepWindow
    from tollgate.operators import cascade, stats, features, metrics, models, splits
    tracked = cascade.track(entities, step_log, spec)
    stats.completion_rates(tracked, spec)
"""

__version__ = "0.1.0"
