"""Spark-native incident-risk analytics.

Every operator is a pure ``DataFrame -> DataFrame`` transformation written with
the DataFrame/SQL API so that Catalyst plans it and the cluster scales it.
"""

from riskbeacon.session import get_session

__all__ = ["get_session"]
