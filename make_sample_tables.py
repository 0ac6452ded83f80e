"""Launcher for spark-submit; see tableferry/plans/sample_cli.py."""

import sys

from tableferry.plans.sample_cli import main

sys.exit(main())
