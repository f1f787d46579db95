"""Entry point for spark-submit."""

from tidemark.plans.cli import main

if __name__ == "__main__":
    main()
