"""Script for spark-submit; see ``sharemill.jobs``."""

from sharemill.jobs import main

if __name__ == "__main__":
    print(main())
