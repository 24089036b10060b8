"""Launcher for spark-submit (a script path cannot use the package's relative imports):

    spark-submit --py-files visitlens.zip run_visitlens.py query <key> --sf-dir DIR [--out PATH]
"""

import sys

from visitlens.__main__ import main

if __name__ == "__main__":
    main(sys.argv[1:])
