import random

import numpy as np
from pyspark.sql import functions as F

from tidewater.llm import decontaminate as D


def distance(item, text):
    """Least edit distance of ``item`` to any stretch of ``text``, by the plain table."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for w in text:
        new = [0]
        for i, x in enumerate(item, 1):
            new.append(min(row[i] + 1, new[i - 1] + 1, row[i - 1] + (x != w)))
        row = new
        best = min(best, row[-1])
    return best


def test_best_fit_equals_the_plain_table():
    rng = random.Random(5)
    for _ in range(200):
        item = [rng.randrange(6) for _ in range(rng.randint(1, 80))]
        text = [rng.randrange(6) for _ in range(rng.randint(0, 90))]
        assert D.best_fit(np.array(item), np.array(text, dtype=np.int64)) == distance(item, text)


def corpus():
    rng = random.Random(11)
    words = [f"w{i}" for i in range(300)]
    items = [(i, [rng.choice(words) for _ in range(rng.randint(8, 60))]) for i in range(30)]
    docs = []
    for d in range(200):
        text = [rng.choice(words) for _ in range(rng.randint(0, 150))]
        if d % 3 == 0:
            item = list(items[d % 30][1])
            for _ in range(rng.randint(0, len(item) // 8)):
                kind, at = rng.randrange(3), rng.randrange(len(item))
                if kind == 0:
                    item[at] = rng.choice(words)
                elif kind == 1:
                    item.insert(at, rng.choice(words))
                else:
                    del item[at]
            at = rng.randint(0, len(text))
            text[at:at] = item
        docs.append((d, text))
    return docs, items


def test_equals_brute_force(spark, docs_of):
    docs, items = corpus()
    want = {(d, i): distance(item, text) for d, text in docs for i, item in items}
    want = {k: v for k, v in want.items() if v <= D.allowed_edits(len(items[k[1]][1]))}
    table = spark.createDataFrame([(i, " ".join(t).upper()) for i, t in items], "item_id long, text string")
    got = D.find_contaminated(docs_of([(d, "\n".join(t)) for d, t in docs]), table)
    got = {(r.doc_id, r.item_id): r.distance for r in got.collect()}
    assert len(want) > 40 and got == want


ITEM = "which of these twelve plain words makes the question hard to answer well"


def test_edge_cases(spark, docs_of):
    items = spark.createDataFrame([(1, ITEM), (1, ITEM), (2, None), (None, ITEM), (3, ""), (4, "too short")],
                                  "item_id long, text string")
    docs = docs_of([(1, f"before {ITEM} after"), (2, None), (3, ""), (4, " \n "), (None, ITEM), (1, "clean"),
                    (5, "word " * 200_000 + ITEM), (6, "too short"), (7, ITEM.replace("twelve", "ten"))])
    rows = {(r.doc_id, r.contaminated, tuple(r.item_ids), r.distance) for r in D.contamination_report(docs, items).collect()}
    assert {r[0] for r in rows if r[1]} == {1, 5, 7} and (7, True, (1,), 1) in rows
    clean = D.drop_contaminated(docs.withColumn("_x", F.lit(1)).withColumn("item_id", F.lit(1)), items)
    assert sorted((r.doc_id for r in clean.collect()), key=repr) == sorted([2, 3, 4, None, 6], key=repr)


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.contamination_report(docs_of([(1, ITEM)]), none).first().contaminated is False
    some = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert D.contamination_report(docs_of([]), some).collect() == []


def test_items_in_several_blocks(spark, docs_of, monkeypatch):
    docs, items = corpus()
    table = spark.createDataFrame([(i, " ".join(t)) for i, t in items[:6]], "item_id long, text string")
    monkeypatch.setattr(D.item_blocks, "__defaults__", (80,))
    frame = docs_of([(d, " ".join(t)) for d, t in docs[:40]])
    split = {(r.doc_id, r.item_id) for r in D.find_contaminated(frame, table).collect()}
    monkeypatch.undo()
    assert split == {(r.doc_id, r.item_id) for r in D.find_contaminated(frame, table).collect()}


def test_short_items_equal_brute_force(spark, docs_of):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(40)]
    items = [(i, [rng.choice(words) for _ in range(3 + i % 7)]) for i in range(42)]
    docs = [(0, items[0][1]), (1, items[2][1][1:]), (2, items[4][1][:3] + ["new"] + items[4][1][3:])]
    for d in range(3, 150):
        text = [rng.choice(words) for _ in range(rng.randint(0, 40))]
        item = list(items[d % 42][1])
        kind, at = rng.randrange(4), rng.randrange(len(item))
        item[at:at + (kind % 2)] = [rng.choice(words)] if kind > 1 else []
        at = rng.randint(0, len(text))
        text[at:at] = item
        docs.append((d, text))
    want = {(d, i): distance(item, text) for d, text in docs for i, item in items}
    want = {k: v for k, v in want.items() if v <= D.allowed_edits(len(items[k[1]][1]))}
    table = spark.createDataFrame([(i, " ".join(t).upper()) for i, t in items], "item_id long, text string")
    got = D.find_contaminated(docs_of([(d, "\n".join(t)) for d, t in docs]), table)
    got = {(r.doc_id, r.item_id): r.distance for r in got.collect()}
    assert len(want) > 100 and set(want.values()) == {0, 1} and got == want


def test_items_of_one_and_two_words_are_searched(spark, docs_of, caplog):
    items = spark.createDataFrame([(1, ITEM), (2, "two Words"), (3, ""), (4, "three words here"), (5, None), (6, "Alone")],
                                  "item_id long, text string")
    assert sorted(r.item_id for r in D.left_out(items).collect()) == [3, 5]
    docs = docs_of([(1, "there are three words here too"), (2, "one two words"), (3, "alone"), (4, "two other words alones")])
    rows = D.contamination_report(docs, items).orderBy("doc_id").collect()
    assert [tuple(r) for r in rows] == [(1, True, [4], 0), (2, True, [2], 0), (3, True, [6], 0), (4, False, [], None)]
    assert "1 benchmark items of fewer than 1 words" in caplog.text
    asked = D.contamination_report(docs, items, min_words=3).where("contaminated").collect()
    assert [r.doc_id for r in asked] == [1]
