"""Entry for spark-submit: see viewstar/jobs.py."""

from viewstar.jobs import main

if __name__ == "__main__":
    main()
