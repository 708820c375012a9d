"""``python -m geotally ...``: the batch jobs' command line (see ``geotally.plans.jobs``)."""

from .plans.jobs import main

main()
