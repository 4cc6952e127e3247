"""The command line on the invented corpus."""

from __future__ import annotations

import json
import subprocess

import fixtures
from folioscope.cli import main


def test_commands(spark, tmp_path, capsys):
    for path, text in fixtures.FILES.items():
        (tmp_path / "documents" / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "documents" / path).write_text(text, encoding="utf-8")
    records = tmp_path / "records"
    for path, raw in fixtures.records().items():
        if "broken" not in path and "vat" not in path:
            (records / path).parent.mkdir(parents=True, exist_ok=True)
            (records / path).write_text(raw)
    (records / "schema").mkdir()
    for name, schema in fixtures.SCHEMAS.items():
        (records / "schema" / f"{name}.schema.json").write_text(json.dumps(schema))
    for name, key, items in (("themes", "themes", fixtures.THEMES), ("chronology", "entries", fixtures.CHRONOLOGY), ("gaps", "gaps", fixtures.GAPS)):
        (records / f"{name}.json").write_text(json.dumps({key: items}))

    def run(*args: str) -> tuple[int, str]:
        code = main(["--root", str(tmp_path), *args], spark)
        return code, capsys.readouterr().out

    assert run("index", "--check")[0] == 1
    assert run("index", "--json", str(tmp_path / "index.json")) == (0, "4 documents, 9 sections, 101 words\n")
    assert run("index", "--check")[0] == 0
    assert run("query")[0] == 2 and run("query", "--theme", "none")[0] == 2
    code, out = run("query", "--theme", "care", "--sections", "--top", "1", "--urls")
    assert code == 0 and "[done] loom-notes#h1-loom" in out and "... 4 more" in out
    code, out = run("validate")
    assert code == 1 and "term 'hold' does occur" in out and "FAILED: 14 error(s)" in out
    assert run("ledger")[0] == 2
    assert run("ledger", "--all")[0] == 0 and run("ledger", "--theme", "care", "--check")[0] == 0
    assert run("status", "--check")[0] == 1 and run("status")[0] == 0 and run("status", "--check")[0] == 0
    (tmp_path / "page.html").write_text('<div class="commentary-groups"></div>')
    assert "updated" in run("listing", str(tmp_path / "page.html"))[1]
    (tmp_path / "commits.json").write_text(json.dumps({"sha": "a" * 12, "author_name": "Ann", "diff": "+at /home/ann/x"}))
    code, out = run("secrets", str(tmp_path / "commits.json"), "--name", "Ann")
    assert code == 1 and "2 violation(s) in 1 commit(s)" in out
    assert [d["slug"] for d in json.loads((tmp_path / "index.json").read_text())["documents"]] == ["mordant book", "vat", "loom-notes", "spindle"]
    assert run("secrets")[0] == 2 and run("secrets", "--git", "HEAD")[0] == 2  # nothing named; not a repository


def test_commits_of_a_repository(spark, tmp_path, capsys):
    git = lambda *a: subprocess.run(["git", "-C", str(tmp_path), "-c", "user.name=Ann Example", "-c", "user.email=ann@x.org", *a], check=True, capture_output=True)
    git("init", "-q")
    for name, text in (("a.txt", "fine\n"), ("b.txt", "see /home/ann/x\n"), ("skipped.txt", "at /home/bob/y\n")):
        (tmp_path / name).write_text(text)
        git("add", ".")
        git("commit", "-q", "-m", f"add {name}")
    code = main(["--root", str(tmp_path), "secrets", "--git", "HEAD", "--leave-out", "skipped.txt"], spark)
    out = capsys.readouterr().out
    assert code == 1 and "personal path: see /home/ann/x" in out and "1 violation(s) in 1 commit(s)" in out
    assert main(["--root", str(tmp_path), "secrets", "--git", "HEAD~2"], spark) == 0
