import json
import os

import pytest

from corpusloom.__main__ import main

from .test_sources_and_runs import ONE


COUNTERS = dict.fromkeys(("records_seen", "metadata_ingested", "judgment_pdf_ingested", "sc_judgment_pdf_ingested", "gdrive_uploaded", "unchanged", "errors"), 0)


def run(capsys, *args):
    assert main(list(args)) == 0
    return [json.loads(line) for line in capsys.readouterr().out.splitlines() if line.startswith("{")]


def test_scrape_ingest_ask_inspect(spark, tmp_path, capsys):
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages" / "2025.html").write_text(ONE)
    root = f"file://{tmp_path}/root"
    assert run(capsys, "scrape", "--root", root, "--pages", str(tmp_path / "pages"))[0]["parsed"] == 2
    again = run(capsys, "scrape", "--root", root, "--pages", str(tmp_path / "pages"), "--run-ts", "2025-01-01T00:00:00Z")
    assert again[0]["parsed"] == 2 and again[1] == {"year": 2025, "hint": 3, "parsed": 2}
    spark.createDataFrame([("REC_2025_1", "judgment_pdf", "text")], "record_id string, kind string, text string").write.parquet(str(tmp_path / "texts"))
    assert run(capsys, "ingest", "--root", root, "--texts", str(tmp_path / "texts")) == [COUNTERS | {"records_seen": 2, "metadata_ingested": 2}]
    assert run(capsys, "ingest", "--root", root, "--texts", str(tmp_path / "texts")) == [COUNTERS | {"records_seen": 2, "unchanged": 2}]
    reply = run(capsys, "ask", "--root", root, "--question", "W.P 1 A Vs B", "--top-k", "1")[0]
    assert reply["sources"][0]["record_id"] == "REC_2025_1"
    rows = {r["id"]: r["found"] for r in run(capsys, "inspect", "--root", root, "--ids", "REC_2025_1", "nope")}
    assert rows == {"REC_2025_1": True, "nope": False}
    (tmp_path / "totals.csv").write_text("year,site_total\n2025,3\n")
    assert run(capsys, "totals", "--root", root, "--totals", str(tmp_path / "totals.csv"))[0]["gap"] == 1
    found = run(capsys, "reconcile", "--root", root, "--texts", str(tmp_path / "texts"))
    assert {r["status"] for r in found if "status" in r} == {"orphan_text", "owned_paths"} and found[-1]["first"][0]["record_id"] == "REC_2025_1"
    assert run(capsys, "set_field", "--root", root, "--ids", "REC_2025_1", "--field", "category", "--value", "Tax") == [{"patched": 1}]
    assert run(capsys, "schedule", "--root", root, "--pages", str(tmp_path / "pages"), "--rounds", "0") == [{"runs": 0}]


def test_migrate_and_audit(spark, tmp_path, capsys):
    root, files = f"file://{tmp_path}/root", tmp_path / "downloaded_pdfs"
    files.mkdir()
    (files / "a.pdf").write_bytes(b"%PDF-1")
    (files / "b.pdf").write_bytes(b"<html>")
    (tmp_path / "old.json").write_text(json.dumps([{"id": i, "year": 2020, "serial_no": 1, "local_pdf_path": f"C:\\x\\{i}.pdf"} for i in "abc"]))
    counts = {r["outcome"]: r["count"] for r in run(capsys, "migrate", "--root", root, "--legacy", str(tmp_path / "old.json"), "--files", str(files))}
    assert counts == {"kept": 2, "cleared": 1}
    (tmp_path / "texts" / "judgment_pdf").mkdir(parents=True)
    for i in "abc":
        (tmp_path / "texts" / "judgment_pdf" / f"{i}.md").write_text("text")
    audit = ("audit", "--root", root, "--files", str(files), "--text-files", str(tmp_path / "texts"))
    *actions, total = run(capsys, *audit)
    assert [(r["id"], r["action"][:14]) for r in actions] == [("b", "DELETE + CLEAR"), ("c", "DELETE orphane")]
    assert total == {"checked": 3, "findings": 2, "cleared": 1, "repaired": False} and (files / "b.pdf").exists()
    run(capsys, *audit, "--repair")
    assert not (files / "b.pdf").exists() and (files / "a.pdf").exists() and not (tmp_path / "texts" / "judgment_pdf" / "c.md").exists()
    assert [(r["id"], r["action"][:14]) for r in run(capsys, *audit)[:-1]] == [("b", "DELETE orphane")]  # its file is gone only now
    counts = {r["status"]: r["count"] for r in run(capsys, "reconcile", "--root", root, "--files", str(files), "--text-files", str(tmp_path / "texts")) if "status" in r}
    assert counts == {"consistent": 1, "orphan_text": 1, "owned_paths": 1}
    assert {r["id"]: r["judgment_file"] for r in run(capsys, "inspect", "--root", root, "--files", str(files), "--ids", "a", "b")} == {"a": True, "b": False}
    assert run(capsys, "convert", "--list", "--root", root, "--files", str(files), "--text-files", str(tmp_path / "texts")) == []
    os.utime(files / "a.pdf", (2e9, 2e9))
    assert [r["record_id"] for r in run(capsys, "convert", "--list", "--root", root, "--files", str(files), "--text-files", str(tmp_path / "texts"))] == ["a"]
    (tmp_path / "bad.json").write_text(json.dumps({"id": "x"}))
    with pytest.raises(ValueError):
        main(["migrate", "--root", root, "--legacy", str(tmp_path / "bad.json"), "--files", str(files)])


def test_scrape_convert_publish_ingest_ask(spark, tmp_path, capsys):
    """Documents are there; one has no text of its own, one is broken. A second run of everything does nothing; a changed file is converted alone."""
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages" / "2025.html").write_text(ONE)
    root, files, texts, shared = f"file://{tmp_path}/root", tmp_path / "files", tmp_path / "texts", tmp_path / "shared"
    (files / "judgments").mkdir(parents=True)
    (texts / "judgment_pdf").mkdir(parents=True)
    (files / "judgments" / "foo.pdf").write_bytes(b"%PDF-1.4\nincome tax appeal\fdismissed with costs")
    (files / "judgments" / "bar.pdf").write_bytes(b"%PDF-1.4\n\xff\xfe")
    run(capsys, "scrape", "--root", root, "--pages", str(tmp_path / "pages"), "--run-ts", "2025-01-01T00:00:00Z")
    for i, name in (("REC_2025_1", "foo"), ("REC_2025_01", "bar")):
        run(capsys, "set_field", "--root", root, "--ids", i, "--field", "judgment_local_pdf_path", "--value", f"judgments/{name}.pdf")
    run(capsys, "audit", "--root", root, "--files", str(files), "--repair")  # gives them their hashes
    convert = ("convert", "--root", root, "--files", str(files), "--text-files", str(texts))
    assert {r["record_id"] for r in run(capsys, *convert, "--list")} == {"REC_2025_1", "REC_2025_01"}
    bad, counts = run(capsys, *convert)
    assert (bad["record_id"], bad["error"][:18]) == ("REC_2025_01", "UnicodeDecodeError") and counts == {"converted": 1, "with_ocr": 0, "failed": 1}
    assert (texts / "judgment_pdf" / "REC_2025_1.md").read_text() == "income tax appeal\n\ndismissed with costs"
    assert [r["item"] for r in run(capsys, "failures", "--root", root)] == ["judgment_pdf/REC_2025_01"]
    ingest = ("ingest", "--root", root, "--text-files", str(texts), "--files", str(files), "--publish", str(shared))
    assert run(capsys, *ingest) == [COUNTERS | {"records_seen": 2, "metadata_ingested": 2, "judgment_pdf_ingested": 1, "gdrive_uploaded": 2}]
    assert len([p for p in shared.iterdir() if not p.name.startswith(".")]) == 2
    stamps = {p: p.stat().st_mtime_ns for p in shared.iterdir()}
    assert run(capsys, *ingest) == [COUNTERS | {"records_seen": 2, "unchanged": 2}] and stamps == {p: p.stat().st_mtime_ns for p in shared.iterdir()}
    assert run(capsys, *convert)[-1] == {"converted": 0, "with_ocr": 0, "failed": 1}  # the broken one is tried again
    reply = run(capsys, "ask", "--root", root, "--question", "income tax appeal dismissed", "--chunk-type", "judgment_pdf")[0]
    assert reply["sources"][0]["record_id"] == "REC_2025_1"
    (files / "judgments" / "bar.pdf").write_bytes(b"%PDF-1.4\nland dispute")
    os.utime(files / "judgments" / "bar.pdf", (2e9, 2e9))
    assert run(capsys, *convert) == [{"converted": 1, "with_ocr": 0, "failed": 0}] and run(capsys, "failures", "--root", root) == []
    assert run(capsys, "export", "--root", root, "--to", str(tmp_path / "json")) == [{"exported": 2}]
    lines = [json.loads(x) for p in sorted((tmp_path / "json").glob("part-*")) for x in p.read_text().splitlines()]
    assert [r["id"] for r in lines] == ["REC_2025_01", "REC_2025_1"] and all(r["judgment_gdrive_view_url"].startswith(str(shared)) and "category" in r for r in lines)
    again = f"file://{tmp_path}/again"
    assert run(capsys, "restore", "--root", again, "--source", str(tmp_path / "json")) == [{"restored": 2}]
    (tmp_path / "array.json").write_text(json.dumps([*lines, lines[0] | {"case_info": "the last counts"}]))
    assert run(capsys, "restore", "--root", again, "--source", str(tmp_path / "array.json")) == [{"restored": 2}]
    run(capsys, "export", "--root", again, "--to", str(tmp_path / "json2"))
    assert "the last counts" in "".join(p.read_text() for p in (tmp_path / "json2").glob("part-*"))
    assert run(capsys, "set_field", "--root", root, "--ids", "REC_2025_1", "--field", "category") == [{"patched": 1}]
    run(capsys, "export", "--root", root, "--to", str(tmp_path / "json"))
    assert [json.loads(x)["category"] for p in (tmp_path / "json").glob("part-*") for x in p.read_text().splitlines() if "REC_2025_1" in x] == [None]


def test_a_broken_store_is_set_aside(spark, tmp_path, capsys):
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages" / "2025.html").write_text(ONE)
    scrape = ("scrape", "--root", f"file://{tmp_path}/root", "--pages", str(tmp_path / "pages"))
    run(capsys, *scrape)
    for f in (tmp_path / "root" / "records").rglob("*.parquet"):
        f.write_bytes(b"{not parquet")
        (f.parent / f".{f.name}.crc").unlink()
    assert run(capsys, *scrape)[0]["inserted"] == 2 and len(list((tmp_path / "root").glob("records.corrupt-*"))) == 1
