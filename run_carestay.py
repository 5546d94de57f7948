"""Launcher for spark-submit: ``spark-submit --py-files carestay.zip run_carestay.py <tables> <out> [--cluster]``."""

import sys

from carestay.__main__ import main

if __name__ == "__main__":
    main(sys.argv[1:])
