import os

import pytest
from pyspark.sql import functions as F

from tests.golden import WORD_COUNTS, WORD_LINES as WORDS
from tidewater import sinks, sources
from tidewater.operators import words as W
from tidewater.operators.observe import metrics, observed
from tidewater.streaming import sources as S



def test_text_glob_and_text_sink(spark, tmp_dir):
    for i, chunk in enumerate([WORDS[:3], WORDS[3:]]):
        with open(os.path.join(tmp_dir, f"part{i}.txt"), "w") as f:
            f.write("\n".join(chunk) + "\n")
    lines = sources.read_lines(spark, os.path.join(tmp_dir, "part*.txt"))
    counts = W.count_words(lines)
    out = os.path.join(tmp_dir, "out")
    sinks.write_text(W.format_counts(counts), out)
    assert sorted(r.value for r in spark.read.text(out).collect()) == WORD_COUNTS


def test_stream_source_needs_exactly_one_name(spark):
    with pytest.raises(ValueError):
        S.string_stream(spark)
    with pytest.raises(ValueError):
        S.string_stream(spark, topic="/a", subscription="/b")


def test_same_operator_on_batch_and_stream(spark, tmp_dir):
    src = os.path.join(tmp_dir, "lines")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("\n".join(WORDS) + "\n")
    stream = S.string_stream(spark, subscription=src)
    counts = W.count_words(stream)
    q = (counts.writeStream.outputMode("complete").format("memory")
               .queryName("wc_stream").trigger(availableNow=True).start())
    q.awaitTermination()
    got = {r.word: r.n for r in spark.table("wc_stream").collect()}
    assert got == {"hi": 5, "there": 1, "sue": 2, "bob": 2}


def test_windowed_count_on_stream(spark, tmp_dir):
    src = os.path.join(tmp_dir, "timed")
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as f:
        f.write('{"ts": "2024-01-01T00:01:00", "value": "a b"}\n{"ts": "2024-01-01T00:12:00", "value": "a"}\n')
    stream = spark.readStream.schema("ts timestamp, value string").json(src)
    counts = W.count_words(stream, extra_keys=[F.window("ts", "10 minutes").alias("window")])
    q = (counts.writeStream.outputMode("complete").format("memory").queryName("wwc")
               .trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted((r.window.start.minute, r.word, r.n) for r in spark.table("wwc").collect())
    assert got == [(0, "a", 1), (0, "b", 1), (10, "a", 1)]


def test_observed_metrics(spark):
    df = observed(sources.from_strings(spark, WORDS), "lines_seen",
                  F.sum(F.length("value")).alias("chars"))
    assert df.count() == 6
    m = metrics("lines_seen")
    assert m["rows"] == 6 and m["chars"] == sum(len(w) for w in WORDS)


def test_shared_dir_when_unset():
    from tidewater.session import shared_dir

    class Conf:
        def get(self, k, default=None):
            return default

    class Ctx:
        def __init__(self, master="local[2]"):
            self.d, self.master = None, master

        def getCheckpointDir(self):
            return self.d

        def setCheckpointDir(self, d):
            self.d = d

    class Sess:
        conf = Conf()

        def __init__(self, master="local[2]"):
            self.sparkContext = Ctx(master)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):  # a cluster shares no local folder
        shared_dir(Sess("yarn"))
    s = Sess()
    d = shared_dir(s)
    assert os.path.isdir(d) and s.sparkContext.d == d
    assert shared_dir(s) == d


def test_string_passthrough_job_counts(spark, tmp_dir):
    from tidewater.streaming import jobs
    src = os.path.join(tmp_dir, "topic")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("\n".join(WORDS) + "\n")
    q = jobs.start_string_passthrough(spark, subscription=src, trigger={"availableNow": True},
                                      checkpoint=os.path.join(tmp_dir, "ck"))
    q.awaitTermination()
    seen = [p["observedMetrics"]["strings_seen"] for p in q.recentProgress if p.get("observedMetrics")]
    assert sum(m["strings"] for m in seen) == 6
    assert sum(m["chars"] for m in seen) == sum(len(w) for w in WORDS)
