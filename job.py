"""``spark-submit job.py <job> <input> <output> [options]``; see ``areastats/jobs.py``."""

from areastats.jobs import main

main()
