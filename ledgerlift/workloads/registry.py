"""All registered queries; importing the modules registers them."""

from ledgerlift.workloads import checks, defects, investigation, issues, matching, migration  # noqa: F401
from ledgerlift.workloads.base import ORACLES, QUERIES  # noqa: F401
