"""Job file for ``spark-submit``; the package goes along with ``--py-files``."""

import sys

from tablesync.plans.job import main

if __name__ == "__main__":
    sys.exit(main())
