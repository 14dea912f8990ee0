from creditloom.plans.batch import DAILY, WEEKLY, open_feeds, report, run, run_exclusions, run_gold, run_silver
from creditloom.plans.tables import Locations
from creditloom.plans.views import deploy_functions, deploy_views, weekly_scores

__all__ = [
    "DAILY",
    "WEEKLY",
    "Locations",
    "deploy_functions",
    "deploy_views",
    "open_feeds",
    "report",
    "run",
    "run_exclusions",
    "run_gold",
    "run_silver",
    "weekly_scores",
]
