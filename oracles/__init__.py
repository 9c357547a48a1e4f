"""DuckDB SQL that answers every registered query on the same tables, written independently of the Spark code."""

from oracles.channels import ORACLES as _CHANNELS
from oracles.cleaning import ORACLES as _CLEANING
from oracles.filing import ORACLES as _FILING
from oracles.matching import ORACLES as _MATCHING
from oracles.revenue import ORACLES as _REVENUE

ORACLES: dict[str, str] = {**_FILING, **_CLEANING, **_MATCHING, **_REVENUE, **_CHANNELS}
