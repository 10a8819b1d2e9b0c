"""Sources with strict contracts, and tables that keep state."""

from siltworks.sources.paged import ScanError, check_pages, whole_chains
from siltworks.sources.state import StateTable

__all__ = ["ScanError", "StateTable", "check_pages", "whole_chains"]
