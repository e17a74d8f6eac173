"""promolift: promotion-lift forecasting as lazy PySpark DataFrame operators.

Layout
------
sources/    readers, writers, fixtures built from the driver tables, calendar reshaping
functions/  column-expression helpers (dates, units, math, metrics, exact statistics)
operators/  DataFrame -> DataFrame operators (universe, campaign tagging, weekly
            roll-ups, features, training frames, models, forecasts, reports)
plans/      compositions into jobs (preprocess, forecast, backtest, tuning) and the
            registered query set used by ``__spark_entry__``
streaming/  note on streaming (the modelled pipeline is batch only)
"""

__version__ = "0.1.0"
