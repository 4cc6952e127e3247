"""Commits of a git repository as rows; git itself lists and prints them."""

from __future__ import annotations

import subprocess

from pyspark.sql import DataFrame, SparkSession

COMMITS = "sha string, author_name string, author_email string, committer_name string, committer_email string, message string, diff string"
HEADER = "%H%x00%an%x00%ae%x00%cn%x00%ce%x00%B"


def git(repository: str, *arguments: str) -> str:
    """Output of a git command; ValueError with git's own words where it fails."""
    done = subprocess.run(["git", "-C", repository, *arguments], capture_output=True, encoding="utf-8", errors="replace", check=False)
    if done.returncode:
        raise ValueError(done.stderr.strip() or f"git {arguments[0]} failed")
    return done.stdout


def read_commits(spark: SparkSession, repository: str, revisions: list[str], leave_out: tuple[str, ...] = ()) -> DataFrame:
    """The commits that ``git rev-list`` names for ``revisions``, with their diffs without context.

    ``leave_out`` lists paths whose changes are not read."""
    paths = ["--", ".", *(f":(exclude){p}" for p in leave_out)]
    rows = []
    for sha in git(repository, "rev-list", *revisions, "--").split():
        *fields, message = git(repository, "show", "-s", f"--format={HEADER}", sha).split("\x00", 5)
        diff = git(repository, "show", "--format=", "--no-color", "--no-ext-diff", "--unified=0", sha, *paths)
        rows.append((*fields, message.strip("\n"), diff))
    return spark.createDataFrame(rows, COMMITS)
