from __future__ import annotations

import glob
import itertools
import os
import random
import re
import threading

import pytest

from llm_fixtures import docs, nothing, texts  # noqa: F401
from merchant_features.llm import filter_audit as A
from merchant_features.sources.storage import shared_dir


def plain(rows, labels):
    """Rows are (id, text, part); labels (id, quality, toxic)."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    failed = []
    for i, text, part in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), "D": bool(re.search("[#$%&*|]", text)),
            "E": i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows),
        }
        failed.append((part or "", {f for f in "ABCDE" if fails[f]}, i in good, i in toxic))
    out = {}
    for part in {f[0] for f in failed}:
        own = [f for f in failed if f[0] == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            gone = [False] * len(own)
            for step, f in enumerate(order, 1):
                here = [f in o[1] for o in own]
                removed = [h and not g for h, g in zip(here, gone, strict=True)]
                row = [
                    sum(not (h or g) for h, g in zip(here, gone, strict=True)), sum(removed),
                    sum(h and g for h, g in zip(here, gone, strict=True)), sum(o[1] == {f} for o in own),
                    sum(r and o[2] for r, o in zip(removed, own, strict=True)), sum(r and o[3] for r, o in zip(removed, own, strict=True)),
                ]
                out[part, "".join(order), step] = row
                total[f] += row[1]
                gone = [g or h for g, h in zip(gone, here, strict=True)]
        for order in itertools.permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                out[part, "".join(order), step].append(total[f])
    return {k: tuple(v) for k, v in out.items()}


def told(df):
    columns = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {(r.part, r.filter_order, r.step): tuple(r[c] for c in columns) for r in df.collect()}


def corpus(seed, n):
    rng = random.Random(seed)
    bodies = [
        " ".join(rng.choice(("one", "Two", "three", "f#ur", "FIVE", f"w{rng.randrange(500)}")) for _ in range(rng.choice((3, 40, 210, 400))))
        for _ in range(n // 3)
    ]
    bodies += ["", None, " ".join(f"only{k}" for k in range(250))]
    rows = [(k, rng.choice(bodies), rng.choice(("a", "b", None, ""))) for k in range(n)]
    rows += [(None, rows[5][1], "a"), (None, rows[5][1], "a"), rows[3], rows[3], (rows[7][0], rows[8][1], "b")]
    rng.shuffle(rows)
    labels = [(k, rng.choice((0, 1, None)), rng.choice((0, 1))) for k in range(0, n, 2)] + [(4, 1, 0), (None, 1, 1)]
    return rows, labels


@pytest.fixture()
def written(spark, tmp_path):
    def write(rows, parts):
        for k in range(parts):
            df = spark.createDataFrame(rows[k::parts], "doc_id long, text string, source string")
            df.selectExpr("*", "1 AS part", "2 AS mask", "3 AS n").coalesce(1).write.mode("append").parquet(str(tmp_path / "documents.parquet"))
        return str(tmp_path / "documents.parquet")

    return write


def test_all_orders_over_many_batches(spark, written, monkeypatch):
    """Smaller ids come in later files, so that earlier counts are taken back."""
    monkeypatch.setattr(A, "SETTLED_ROWS", 7)
    rows, labels = corpus(1, 90)
    rows.sort(key=lambda r: -(r[0] or 0))
    rows = [r for k in range(3) for r in rows[k * 32 : (k + 1) * 32]]
    size = -(-len(rows) // 3)
    dealt = [rows[(k % 3) * size + k // 3] for k in range(3 * size) if (k % 3) * size + k // 3 < len(rows)]
    path = written(dealt, 3)
    given = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    folder = f"{shared_dir(spark)}/audit-test"
    changes = A.count_changes(A.file_stream(spark, path, 1), given, folder, 5)
    assert changes.where("n < 0").count() > 0
    assert told(A.report(changes)) == plain(rows, labels)

    # the stream goes on where it was: a smaller id takes back what all before had counted
    more = [(-1, rows[0][1], "c"), (-2, None, "a")]
    spark.createDataFrame(more, "doc_id long, text string, source string").selectExpr("*", "1 AS part", "2 AS mask", "3 AS n").write.mode("append").parquet(path)
    again = A.count_changes(A.file_stream(spark, path, 1), given, folder, 5)
    assert told(A.report(again)) == plain(rows + more, labels)


def test_odd_texts(spark, texts, written):
    rows = [(k, t, ("a", None)[k % 2]) for k, t in enumerate(texts)]
    labels = [(k, k % 2, k % 3 == 0) for k in range(0, len(rows), 4)]
    given = spark.createDataFrame([(i, q, int(t)) for i, q, t in labels], "doc_id long, quality int, toxic int")
    assert told(A.audit_files(spark, written(rows, 1), given)) == plain(rows, labels)


def test_an_empty_table_and_one_file(spark, tmp_path):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    path = str(tmp_path / "empty.parquet")
    spark.createDataFrame([], "doc_id long, text string, source string").write.parquet(path)
    assert A.audit_files(spark, path, labels).count() == 0
    spark.createDataFrame([(1, "x", "s")], "doc_id long, text string, source string").coalesce(1).write.parquet(str(tmp_path / "one"))
    (file,) = (str(f) for f in (tmp_path / "one").iterdir() if f.name.startswith("part-"))
    assert A.audit_files(spark, file, labels).count() == 600


def test_state_stores_take_no_disk_in_advance(spark, written):
    """There is a store for every shuffle partition, most of them small."""
    local = os.path.dirname(spark.sparkContext._temp_dir)
    found = lambda: glob.glob(f"{glob.escape(local)}/**/MANIFEST-*", recursive=True)
    earlier, taken, over = set(found()), {}, threading.Event()

    def watch():
        while not over.wait(0.05):
            for path in set(found()) - earlier:
                try:
                    taken[path] = max(taken.get(path, 0), os.stat(path).st_blocks * 512)
                except OSError:
                    pass

    watching = threading.Thread(target=watch)
    watching.start()
    try:
        rows, labels = corpus(3, 60)
        given = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
        before = {name: spark.conf.get(name, None) for name in A.STATE}
        assert told(A.audit_files(spark, written(rows, 2), given)) == plain(rows, labels)
        assert {name: spark.conf.get(name, None) for name in A.STATE} == before
    finally:
        over.set()
        watching.join()
    assert taken and max(taken.values()) < 1_000_000
