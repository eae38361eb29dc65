"""Spark-native tabular profiling, preparation, classification and evaluation."""

from gaugeframe.operators import *  # noqa: F401,F403
from gaugeframe.plans import *  # noqa: F401,F403
from gaugeframe.sources import *  # noqa: F401,F403
