"""Entry point for spark-submit."""

from daytally.plans.jobs import main

if __name__ == "__main__":
    main()
