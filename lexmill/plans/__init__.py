"""Spark-native corpus building and auditing."""

from . import audits as audits  # registers its queries
from . import registries as registries  # registers its queries
from . import relations as relations  # registers its queries
from . import collection as collection  # registers its queries
from . import statistics as statistics  # registers its queries
