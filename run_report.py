"""Entry point for ``spark-submit``; the same as ``python -m tarmac``."""

import runpy

if __name__ == "__main__":
    runpy.run_module("tarmac", run_name="__main__")
