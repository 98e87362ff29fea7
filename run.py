"""Script for spark-submit; same options as ``python -m billmill``."""

from billmill.__main__ import main

if __name__ == "__main__":
    main()
