"""``python -m trendlens <job> ...``: see :mod:`trendlens.jobs`."""

from .jobs import main

main()
