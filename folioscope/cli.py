"""Command line: index, query, validate, ledger, status, secrets, listing.

``root`` holds documents/<author>/*.md and records/ with themes.json,
chronology.json, gaps.json, schema/*.schema.json, extractions/<theme>/*.json and
inheritance/*.json; the index is kept in records/index.  Exit codes: 0 fine, 1
out of date or failed, 2 wrong arguments.
"""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.operators import search, secrets, validation
from folioscope.operators.sections import index_documents, totals
from folioscope.plans import ledger, listing, status
from folioscope.sources import corpus, history, reports


class Project:
    def __init__(self, spark: SparkSession, root: str, site: str = ""):
        self.spark, self.root, self.site = spark, root.rstrip("/"), site
        self.records = f"{self.root}/records"
        self.index = f"{self.records}/index"

    def fresh(self) -> tuple[DataFrame, DataFrame]:
        """Documents and sections as they are now."""
        documents, sections = index_documents(corpus.read_documents(self.spark, f"{self.root}/documents"), self.site)
        return documents.persist(), sections.persist()

    def stored(self) -> tuple[DataFrame, DataFrame]:
        return corpus.read_index(self.spark, self.index)

    def registry(self, name: str, key: str, schema: str) -> DataFrame:
        return corpus.read_registry(self.spark, f"{self.records}/{name}.json", key, schema)

    def themes(self) -> DataFrame:
        return self.registry("themes", "themes", corpus.THEMES)

    def theme_rows(self) -> dict[str, dict]:
        """The theme registry is an authored list; the last of two equal ids counts."""
        return {r["id"]: r.asDict() for r in self.themes().orderBy("position").collect()}

    def chronology(self) -> DataFrame:
        return self.registry("chronology", "entries", corpus.CHRONOLOGY)

    def gaps(self) -> DataFrame:
        return self.registry("gaps", "gaps", corpus.GAPS)

    def extractions(self) -> DataFrame:
        return corpus.read_records(self.spark, f"{self.records}/extractions", corpus.EXTRACTION)

    def inheritance(self) -> DataFrame:
        return corpus.read_records(self.spark, f"{self.records}/inheritance", corpus.INHERITANCE)

    def schemas(self) -> dict[str, dict]:
        return {p.name.split(".")[0]: json.loads(p.read_text(encoding="utf-8")) for p in Path(self.records, "schema").glob("*.schema.json")}


def index(p: Project, args) -> int:
    documents, sections = p.fresh()
    if args.check:
        try:
            stored, stored_sections = p.stored()
        except FileNotFoundError:
            print("the index is missing")
            return 1
        same = reports.differences(documents, stored).isEmpty() and reports.differences(sections, stored_sections).isEmpty()
        print("the index is up to date" if same else "the index is out of date")
        return 0 if same else 1
    corpus.write_index(documents, sections, p.index)
    if args.json:
        reports.write_json(documents.drop("norm_text"), args.json, ["author", "path"], "documents")
    n = totals(documents, sections).first()
    print(f"{n['documents']} documents, {n['sections']} sections, {n['words']:,} words")
    return 0


def query(p: Project, args) -> int:
    themes = p.theme_rows() if args.theme else {}
    if args.theme and args.theme not in themes and not args.terms:
        print(f"unknown theme {args.theme!r}; known: {', '.join(sorted(themes))}")
        return 2
    terms = [t.strip() for t in (args.terms or "").split(",") if t.strip()] or (themes[args.theme]["search_terms"] if args.theme else [])
    if not terms:
        print("give --theme or --terms")
        return 2
    covered = search.covered_locators(p.extractions(), args.theme) if args.theme else None
    documents, sections = p.stored()
    found = search.search(documents, sections, terms, args.sections, args.commentary, args.author, args.top, args.min_hits, covered).orderBy("rank").collect()
    total = found[0]["total"] if found else 0
    print(f"{args.terms or args.theme} - {total} {'sections' if args.sections else 'documents'} with hits\n")
    for r in found:
        if not args.sections:
            print(f"{r['hits']:5d}  {r['author']:<6} {r['slug']}")
            continue
        print(f"{r['hits']:5d}  {'[done] ' if r['done'] else ''}{r['locator']}")
        print(f"       {' > '.join(r['path'])}  (lines {r['line_start']}-{r['line_end']}, {r['words']} words)")
        if args.urls:
            print(f"       {r['url']}")
    if total > len(found):
        print(f"\n... {total - len(found)} more (use --top)")
    return 0


def validate(p: Project, args) -> int:
    documents, sections = p.fresh()
    try:
        stored = p.stored()[0]
    except FileNotFoundError:
        stored = None
    schemas = p.schemas()
    files = p.spark.createDataFrame([(str(x.relative_to(p.root)),) for x in Path(p.root).rglob("*") if x.is_file()], "path string")
    found = validation.validate(documents, sections, p.themes(), p.chronology(), p.gaps(), files, p.extractions(), p.inheritance(), schemas, stored)
    parts = [found]
    for name in ("themes", "chronology", "gaps"):  # V1
        path = Path(p.records, f"{name}.json")
        if path.exists() and "registry" in schemas:
            raw = p.spark.createDataFrame([(path.name, path.read_text(encoding="utf-8"))], "path string, raw string")
            parts.append(validation.schema_rule(raw, "V1", schemas["registry"]["$defs"][name], schemas["registry"]))
    found = validation.union(parts).persist()
    for r in found.orderBy(F.desc("severity"), "file", "item", "rule", "message").collect():  # a report for people
        print(f"{r['severity']}: {r['file']}{f' [{r["item"]}]' if r['item'] else ''}: {r['message']}")
    n = validation.verdict(found, args.strict).first()
    if n["failed"]:
        print(f"\nFAILED: {n['errors']} error(s), {n['warnings']} warning(s)")
    elif not args.quiet:
        print("OK")
    return int(n["failed"])


def write_or_check(lines: DataFrame, path: str, check: bool) -> int:
    if check:
        same = reports.up_to_date(lines, path)
        print(f"{path} is {'up to date' if same else 'out of date'}")
        return 0 if same else 1
    reports.write_text(lines, path)
    print(f"wrote {path}")
    return 0


def ledgers(p: Project, args) -> int:
    themes = p.theme_rows()
    if args.theme and args.theme not in themes or not (args.theme or args.all):
        print(f"give --all or a --theme of: {', '.join(sorted(themes))}")
        return 2
    documents, sections = p.stored()
    have = [r["theme"] for r in ledger.themes_with_records(p.extractions()).collect()] if args.all else [args.theme]
    codes = [write_or_check(ledger.ledger(themes[t], p.extractions(), p.chronology(), documents, sections), f"{p.records}/ledgers/{t}-ledger.md", args.check) for t in sorted(t for t in have if t in themes)]
    return max(codes, default=0)


def state(p: Project, args) -> int:
    documents, sections = p.stored()
    lines = status.status(list(p.theme_rows().values()), p.extractions(), p.inheritance(), p.chronology(), p.gaps(), documents, sections)
    return write_or_check(lines, f"{p.records}/STATUS.md", args.check)


def scan(p: Project, args) -> int:
    """Commits of a git repository, or JSON lines of them (sha, diff and header fields)."""
    if bool(args.commits) == bool(args.git):
        print("give a file of commits, or --git with revisions")
        return 2
    if args.git:
        try:
            commits = history.read_commits(p.spark, p.root, args.git, tuple(args.leave_out))
        except ValueError as e:
            print(e)
            return 2
    else:
        commits = p.spark.read.schema(history.COMMITS).json(args.commits)
    found = secrets.scan_lines(secrets.added_lines(commits), args.name, args.email).drop("n").unionByName(secrets.scan_commits(commits, args.name, args.email)).persist()
    for r in found.orderBy("sha", "kind", "snippet").collect():
        print(f"{r['sha'][:10]}: {r['kind']}: {r['snippet']}")
    n = secrets.scan_totals(found).first()
    print(f"{n['violations']} violation(s) in {n['commits']} commit(s)")
    return int(n["violations"] > 0)


def pages(p: Project, args) -> int:
    page = Path(args.page)
    text = page.read_text(encoding="utf-8")
    updated = listing.replace_region(text, listing.listing_html(p.stored()[0]))
    if updated != text:
        page.write_text(updated, encoding="utf-8", newline="\n")
    print(f"{page} {'updated' if updated != text else 'already up to date'}")
    return 0


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="folioscope", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    top.add_argument("--root", default=".")
    top.add_argument("--site", default="")
    sub = top.add_subparsers(dest="command", required=True)
    commands = {"index": index, "query": query, "validate": validate, "ledger": ledgers, "status": state, "secrets": scan, "listing": pages}
    made = {name: sub.add_parser(name) for name in commands}
    for name, f in commands.items():
        made[name].set_defaults(run=f)
    for name in ("index", "ledger", "status"):
        made[name].add_argument("--check", action="store_true")
    q = made["query"]
    for flag in ("--theme", "--terms", "--commentary", "--author"):
        q.add_argument(flag)
    q.add_argument("--sections", action="store_true")
    q.add_argument("--urls", action="store_true")
    q.add_argument("--top", type=int, default=25)
    q.add_argument("--min-hits", type=int, default=1)
    made["validate"].add_argument("--strict", action="store_true")
    made["validate"].add_argument("--quiet", action="store_true")
    made["ledger"].add_argument("--theme")
    made["ledger"].add_argument("--all", action="store_true")
    made["index"].add_argument("--json")
    made["secrets"].add_argument("commits", nargs="?")
    made["secrets"].add_argument("--git", nargs="+", default=[])
    made["secrets"].add_argument("--leave-out", action="append", default=[])
    made["secrets"].add_argument("--name", action="append", default=[])
    made["secrets"].add_argument("--email", action="append", default=[])
    made["listing"].add_argument("page")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("folioscope").getOrCreate()
    return args.run(Project(spark, args.root, args.site), args)


if __name__ == "__main__":
    sys.exit(main())
