"""Plans: the eight marts (queries over the operational tables) and the load runner."""

from martsmith.plans.jobs import MARTS, MartSpec
from martsmith.plans.runner import LoadReport, load_all, load_frame, load_mart, mart_rows

__all__ = ["MARTS", "LoadReport", "MartSpec", "load_all", "load_frame", "load_mart", "mart_rows"]
