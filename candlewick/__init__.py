"""Market-data analytics as plain ``DataFrame -> DataFrame`` functions on Spark."""

from candlewick.config import Config, default_config
from candlewick.session import build_session

__all__ = ["Config", "build_session", "default_config"]
