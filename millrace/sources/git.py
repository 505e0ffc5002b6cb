"""Git repositories as a data source: one partition a repository. It calls git, so it is off until registered."""

from __future__ import annotations

import subprocess

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Git's name of the empty tree (fixed value).
EMPTY_TREE = "4b825dc642cb6eb9a060e54bf8d69288fbee4904"
COMMITS = "repo string, hash string, parent string, timestamp string, message string, files array<string>, is_merge boolean"


def git(repo: str, *args: str) -> str:
    return subprocess.run(["git", "-C", repo, *args], capture_output=True, text=True, errors="replace", check=False).stdout


class Repo(InputPartition):
    def __init__(self, path: str):
        self.path = path


class CommitReader(DataSourceReader):
    """Commits, newest first. Options: paths (comma separated), max_count, since."""

    def __init__(self, options):
        self.options = options

    def partitions(self):
        return [Repo(p) for p in self.options.get("paths", "").split(",") if p]

    def read(self, partition):
        limits = [f"--max-count={self.options.get('max_count', '1000')}"]
        if since := self.options.get("since"):
            limits.append(f"--since={since}")
        log = git(partition.path, "log", *limits, "--name-only", "--format=%x1e%H%x1f%P%x1f%aI%x1f%s%x1f")
        for entry in log.split("\x1e")[1:]:
            commit, parents, at, subject, names = entry.split("\x1f", 4)
            files = [f for f in names.split("\n") if f]
            own = parents.split()
            yield (partition.path, commit, own[0] if own else EMPTY_TREE, at, subject, files, len(own) > 1)


class GitCommits(DataSource):
    """spark.dataSource.register(GitCommits); spark.read.format("git_commits").option("paths", ...)."""

    @classmethod
    def name(cls):
        return "git_commits"

    def schema(self):
        return COMMITS

    def reader(self, schema):
        return CommitReader(self.options)


def range_diffs(df, repo: str = "repo", base: str = "base", head: str = "head", pathspecs: tuple[str, ...] = ()):
    """With `diff`, three lines of context, only of the pathspecs."""

    def run(it):
        for pdf in it:
            spec = ["--", *pathspecs] if pathspecs else []
            yield pdf.assign(diff=[git(r, "diff", "-U3", b, h, *spec) for r, b, h in zip(pdf[repo], pdf[base], pdf[head], strict=True)])

    return df.mapInPandas(run, _with(df, "diff string"))


def file_contents(df, repo: str = "repo", commit: str = "hash", path: str = "path"):
    """With `content`; empty where the file isn't there."""

    def run(it):
        for pdf in it:
            yield pdf.assign(content=[git(r, "show", f"{c}:{p}") for r, c, p in zip(pdf[repo], pdf[commit], pdf[path], strict=True)])

    return df.mapInPandas(run, _with(df, "content string"))


def _with(df, extra: str) -> str:
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields), extra])
