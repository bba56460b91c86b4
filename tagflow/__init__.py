"""tagflow: device-data operators as Spark DataFrame plans.

Captured or landed device data goes in as tables (or streams), one point table
(name, value, timestamp, error) and time-series rows come out.
"""

from tagflow.session import build_session, configure

__all__ = ["build_session", "configure"]
