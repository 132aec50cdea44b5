"""Filter interaction audit against a walk through every document and order."""

import random
import re
from itertools import permutations

import pytest
from tabularium.llm import filteraudit

COLUMNS = "doc_id long, text string, source string, h string, mask string, part string, n string, first string"


def walked(docs, labels):
    """The whole table, one document, order and step at a time."""
    good = {d for d, quality, _ in labels if quality == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    first = {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            first[text or ""] = min(first.get(text or "", doc_id), doc_id)
    rows = {}
    keys = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    for part in {s or "" for _, _, s in docs}:
        for order in permutations("ABCDE"):
            for step in range(1, 6):
                rows[part, "".join(order), step] = dict.fromkeys(keys, 0)
    for doc_id, text, source in docs:
        text, part = text or "", source or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": doc_id is not None and first[text] < doc_id,
        }
        removed_by = {}
        for order in permutations("ABCDE"):
            removed_by[order] = next((x for x in order if fails[x]), None)
        for order, by in removed_by.items():
            gone = False
            for step, x in enumerate(order, 1):
                row = rows[part, "".join(order), step]
                row["kept"] += not (gone or fails[x])
                row["removed"] += not gone and fails[x]
                row["redundant"] += gone and fails[x]
                row["unique_fails"] += fails[x] and sum(fails.values()) == 1
                row["good_lost"] += not gone and fails[x] and doc_id in good
                row["toxic_lost"] += not gone and fails[x] and doc_id in toxic
                row["shapley"] += sum(b == x for b in removed_by.values())
                gone = gone or fails[x]
    return rows


def check(spark, docs, labels):
    frame = spark.createDataFrame([(*d, *"abcde") for d in docs], COLUMNS).repartition(3)
    got = filteraudit.audit(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    expected = walked(docs, labels)
    found = {(r["part"], r["filter_order"], r["step"]): {k: r[k] for k in next(iter(expected.values()))} for r in got}
    assert len(got) == len(found) == len(expected)
    assert found == expected


@pytest.mark.parametrize("seed", [1, 2])
def test_against_a_walk(spark, seed):
    rng = random.Random(seed)
    words = ["a", "b", "Word", "é", "100%", "x" * 30, "UPPER", "of", "日本", "\x1c"]
    texts = [rng.choice(" \n\t").join(rng.choices(words, k=rng.choice([0, 3, 49, 50, 51, 200]))) for _ in range(30)]
    texts += [" ".join(f"w{i}" for i in range(k)) for k in (49, 50, 77)] + [None, "", " "]
    docs = [(i, rng.choice(texts), rng.choice(["s", "t", "", None])) for i in range(200)]
    docs += [(7, texts[0], "s"), (7, texts[0], "s"), (8, texts[1], "s"), (None, texts[0], "t"), (None, None, None)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 300, 2)]
    check(spark, docs, labels + labels[:5] + [(None, 1, 1), (4, 1, 0), (4, 0, 1)])


def test_one_group_of_copies(spark):
    """A third of all rows in one group: all but its smallest id fail E."""
    docs = [(i, "copy " * 60 if i % 3 == 0 else f"text {i}", "s") for i in range(3000)]
    got = filteraudit.audit(
        spark.createDataFrame(docs, "doc_id long, text string, source string"),
        spark.createDataFrame([], "doc_id long, quality int, toxic int"),
    )
    row = got.where("filter_order = 'EABCD' and step = 1").first()
    assert (row["removed"], row["kept"]) == (999, 2001)


def test_every_order_sums_to_the_documents(spark, small):
    rows = filteraudit.op12_filter_audit(spark, small).collect()
    n = spark.read.parquet(f"{small}/documents.parquet").count()
    by_order = {}
    for r in rows:
        total = by_order.setdefault(r["filter_order"], [0, 0])
        total[0] += r["removed"] + (r["kept"] if r["step"] == 5 else 0)
        total[1] += r["shapley"]
    assert len(by_order) == 120 and {t[0] for t in by_order.values()} == {n}
