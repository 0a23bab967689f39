"""``spark-submit`` entry point; see ``martloom/__main__.py``."""

from martloom.__main__ import main

if __name__ == "__main__":
    main()
