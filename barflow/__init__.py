"""barflow: market-data analytics on Spark DataFrames.

Ticks become bars, bars become ordered-series features, features feed
nearest-neighbour and least-squares forecasts, forecasts above a threshold
become positions, and positions are reconciled with fills into profit.
Every step is a DataFrame transformation planned by Catalyst.
"""

from barflow.session import configure, get_session, checkpoint_root  # noqa: F401

__version__ = "0.1.0"
