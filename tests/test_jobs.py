import json
import os

import pytest

from tidewater import jobs, sources
from tidewater.operators.checks import ContentMismatch
from tests.golden import FILTER_COUNTS, FILTER_LINE, WORD_COUNTS, WORD_LINES as WORDS
from tests.test_devicelog_sinks import _device_doc



def _write(path, lines):
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


def test_wordcount_job(spark, tmp_dir):
    src = _write(os.path.join(tmp_dir, "in.txt"), WORDS)
    jobs.wordcount(spark, src, os.path.join(tmp_dir, "out"))
    got = sorted(r.value for r in spark.read.text(os.path.join(tmp_dir, "out")).collect())
    assert got == WORD_COUNTS


def test_debugging_wordcount_job(spark, tmp_dir):
    src = _write(os.path.join(tmp_dir, "in.txt"), [FILTER_LINE])
    kept = jobs.debugging_wordcount(spark, src, expected=FILTER_COUNTS)
    assert kept.count() == 2
    with pytest.raises(ContentMismatch):
        jobs.debugging_wordcount(spark, src, expected=[("Flourish", 2)])


def test_windowed_wordcount_job(spark, tmp_dir):
    src = _write(os.path.join(tmp_dir, "in.txt"), WORDS)
    out = os.path.join(tmp_dir, "out")
    jobs.windowed_wordcount(spark, src, out, 10, 1_704_067_200_000, 1_704_067_200_000 + 3_600_000, 2)
    back = spark.read.text(out)
    assert back.select("day").distinct().count() == 1
    total = sum(int(r.value.split(": ")[1]) for r in back.collect())
    assert total == 10


def test_device_log_job(spark, tmp_dir):
    src = _write(os.path.join(tmp_dir, "log.json"), [json.dumps(_device_doc()), "{}"])
    out = jobs.device_log(spark, src)
    rejected = out["rejected_documents"].first()
    assert out["rejected_documents"].count() == 1 and rejected.document and rejected.missing
    assert [r.n for r in out["transfer_group_sizes"].collect()] == [1]
    assert out["battery_events"].count() == 1
    rat = out["rat_events"].orderBy("t_ms").collect()
    assert [r.tStampMsEnd for r in rat][-1] is None and all(r.n_transfers == 1 for r in rat)


def test_contact_lines(spark):
    shops = spark.createDataFrame([("north", "n1@shops.test"), ("west", "w2@shops.test"), ("west", "w1@shops.test")],
                                  "name string, value string")
    desks = spark.createDataFrame([("north", "desk 9"), ("east", "desk 4"), ("north", "desk 2"), ("north", "desk 5")],
                                  "name string, value string")
    lines = sorted(r.value for r in jobs.contact_lines({"shops": shops, "desks": desks}).collect())
    assert lines == ["NAME east SHOPS : [] DESKS : [desk 4]",
                     "NAME north SHOPS : [n1@shops.test] DESKS : [desk 2, desk 5, desk 9]",
                     "NAME west SHOPS : [w1@shops.test, w2@shops.test] DESKS : []"]


def test_table_scan_job(spark):
    m = jobs.table_scan(spark, "/root/testdata/sf0.001/lineitem.parquet")
    assert m["rows"] == spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()


def test_cli_wordcount(spark, tmp_dir):
    src = _write(os.path.join(tmp_dir, "in.txt"), WORDS)
    assert jobs.main(["wordcount", "--input", src, "--output", os.path.join(tmp_dir, "o")]) == 0
    assert sources.read_lines(spark, os.path.join(tmp_dir, "o")).count() == 4


def test_lines_with_side_record(spark, tmp_dir):
    verse = sources.from_strings(spark, ["a first line of our own", "and a second"])
    rec = _write(os.path.join(tmp_dir, "rec.json"), ['{"name": "side", "n": "1"}'])
    out = jobs.lines_with_side_record(spark, verse, rec).collect()
    assert [r.side["name"] for r in out] == ["side", "side"]
    two = _write(os.path.join(tmp_dir, "two.json"), ['{"a": "1"}', '{"a": "2"}'])
    with pytest.raises(Exception, match="exactly one row"):
        jobs.lines_with_side_record(spark, verse, two).collect()


def test_cli_device_log(spark, tmp_dir):
    src = _write(os.path.join(tmp_dir, "log.json"), [json.dumps(_device_doc())])
    out = os.path.join(tmp_dir, "dl")
    assert jobs.main(["device-log", "--input", src, "--output", out]) == 0
    assert spark.read.json(os.path.join(out, "rat_events")).count() == 3
    assert spark.read.json(os.path.join(out, "action_pairs")).count() == 3
