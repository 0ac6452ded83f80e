"""Launcher for spark-submit; see tableferry/plans/cli.py."""

import sys

from tableferry.plans.cli import main

sys.exit(main())
