"""Command line of the load job, for spark-submit:

    spark-submit job.py <batch_date> load <table> --store-root <dir> [--conf-dir conf]

All work runs as JVM expressions, so executors need no Python code from this
package; only the driver imports it.
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from saltkv.plans.job import main  # noqa: E402

if __name__ == "__main__":
    sys.exit(main())
