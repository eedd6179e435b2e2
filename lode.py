"""Entry point for spark-submit; see ``silverlode/__main__.py``."""

from silverlode.__main__ import main

if __name__ == "__main__":
    main()
