"""vigil — Spark-native incident analytics.

Every operator is a function ``DataFrame -> DataFrame`` (usable with
``df.transform``) that declares its plan with the DataFrame API and leaves
optimisation and execution to Catalyst, AQE and Tungsten.
"""

from vigil.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
