"""The command line mirrors the reference's build / add / rank programs."""

import json
import os

import pytest

from spindle.cli import main


def write_jsonl(path, rows):
    with open(path, "w") as fh:
        for title, text in rows:
            fh.write(json.dumps({"title": title, "text": text, "id": 0}) + "\n")


def test_build_add_rank(spark, scratch, capsys):
    first = os.path.join(scratch, "a.json")
    more = os.path.join(scratch, "b.json")
    write_jsonl(first, [("B", "hello world hello"), ("C", "world-wide world foo,bar"),
                        ("E", "hat hello the end"), ("F", "end note")])
    write_jsonl(more, [("A", "The cat's hat, the HAT!"), ("A", "hat again")])
    assert main(["index", first, os.path.join(scratch, "v1"), "build"], spark) == 0
    assert main(["index", more, os.path.join(scratch, "v2"), "add", os.path.join(scratch, "v1")],
                spark) == 0
    capsys.readouterr()
    assert main(["rank", os.path.join(scratch, "v2"), "bm25", "hello world", "3"], spark) == 0
    lines = capsys.readouterr().out.strip().splitlines()
    assert [ln.split("\t")[1] for ln in lines] == ["B", "C", "E"]
    assert abs(float(lines[0].split("\t")[0]) - 0.656121) < 1e-6


def test_add_needs_old_path(spark, scratch):
    with pytest.raises(SystemExit):
        main(["index", "x.json", os.path.join(scratch, "v"), "add"], spark)
