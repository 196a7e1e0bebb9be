"""Job file for ``spark-submit``; see ``brooklet.plans.deploy``."""

import sys

from brooklet.plans.deploy import main

if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
