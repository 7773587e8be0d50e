"""Operator 4 against brute force over all windows."""

import hashlib
import random

import numpy as np
import pytest

from tidalfed.llm import substrings, suffixes


def brute(rows, window=100):
    """Result of each (doc_id, text); ids ascending, null last."""
    seen, out = {}, []
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    for n, (_, text) in enumerate(order):
        data = (text or "").encode()
        for s in range(len(data) - window + 1):
            seen.setdefault(data[s:s + window], (n, s))
    for n, (doc_id, text) in enumerate(order):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - window + 1):
            if seen[data[s:s + window]] != (n, s):
                gone[s:s + window] = True
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((doc_id, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, **kw):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(map(tuple, substrings.removed_bytes(docs, **kw).collect()), key=str)


def random_rows(seed, number=40):
    rng = random.Random(seed)
    words = ["alpha", "beta", "gämma", "delta", "ep", "ζ", "eta ", "\n"]
    parts = [" ".join(rng.choices(words, k=rng.randint(5, 120))) for _ in range(12)]
    rows = [(i, "".join(rng.choices(parts, k=rng.randint(0, 4)))) for i in range(number)]
    return rows + [(number, None), (number + 1, ""), (number + 2, "x" * 99),
                   (number + 3, "a" * 1000), (number + 4, "ab" * 400), (number + 5, "a" * 100),
                   (None, rows[3][1])]


@pytest.mark.parametrize("most", [0, 4, 64])
def test_equals_brute_force(spark, most):
    rows = random_rows(most)
    assert found(spark, rows, most=most) == brute(rows)


def test_chunks_of_a_batch(spark, monkeypatch):
    data, offsets = [], [0]
    for _, text in random_rows(9):
        data.append((text or "").encode())
        offsets.append(offsets[-1] + len(data[-1]))
    flat, offsets = np.frombuffer(b"".join(data), np.uint8), np.array(offsets)
    for chunk in (1 << 17, 150):
        monkeypatch.setattr(substrings, "CHUNK", chunk)
        windows = sorted(
            (t, s + k) for _, _, ts, ss, ns in substrings.anchors_of(flat, offsets)
            for t, s, n in zip(ts.tolist(), ss.tolist(), ns.tolist()) for k in range(n))
        assert windows == [(t, s) for t, d in enumerate(data) for s in range(len(d) - 99)]


def test_suffix_order():
    rng = random.Random(3)
    for _ in range(50):
        strings = [[rng.randint(1, 3) for _ in range(rng.randint(0, 60))] + [0]
                   for _ in range(5)]
        ends = np.cumsum([len(s) for s in strings])
        starts = ends - [len(s) for s in strings]
        got = suffixes.suffix_arrays(np.array(sum(strings, [])), starts, ends)
        want = [int(a) + i for a, s in zip(starts, strings)
                for i in sorted(range(len(s)), key=lambda i: s[i:])]
        assert got.tolist() == want


def test_repeated_ids_and_rows(spark):
    one, two = "first text " * 20, "another text " * 20
    rows = [(1, one), (1, one), (1, two), (2, one)]
    got = found(spark, rows)
    assert len(got) == 4
    assert [r[2] for r in got if r[0] == 2] == [len(one)]
    same = [r for r in got if r[0] == 1 and r[1] == len(one)]
    assert same[0] == same[1] and same[0][2] < len(one)


def test_empty_table_and_clashing_names(spark):
    assert found(spark, []) == []
    docs = spark.createDataFrame([(2, "ä" * 300, 9, None, 5), (1, None, 1, "x", 0)],
                                 "doc_id long, text string, places int, tag string, n_chars int")
    rows = sorted(substrings.without_repeats(docs).collect())
    assert rows[0]["text"] is None and rows[0]["tag"] == "x" and rows[0]["places"] == 1
    assert rows[1]["n_chars"] == len(rows[1]["text"]) < 300 and rows[1]["doc_id"] == 2


def test_given_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    rows = list(map(tuple, docs.collect()))
    got = sorted(map(tuple, substrings.removed_bytes(docs).collect()), key=str)
    assert got == brute(rows)


def test_contexts_of_a_common_passage_go_on_in_few_parts(spark):
    """A passage between ever other words; a row for each window would be many times the contexts."""
    rng = random.Random(7)
    word = lambda n: "".join(rng.choices("bcdfghjklm", k=n))
    passage = word(70)
    rows = [(i, f"{word(90)}{passage}{word(90)}") for i in range(200)]
    rows += [(i + 200, rows[i][1][60:]) for i in range(0, 200, 9)]
    assert found(spark, rows) == brute(rows)
    texts = spark.createDataFrame([(i, 0, t) for i, t in rows], "doc long, tag long, text string")
    first = substrings.first_occurrences(substrings.anchors(texts, 100))
    wanted = first.join(substrings.by_contexts(first, 64), "key").select(
        "key", "first.*", "many").filter("many")
    held = substrings.contexts(wanted, texts, 100).selectExpr("*", "0L AS at")
    whole, windows = held.count(), held.selectExpr("sum(place & 255)").first()[0]
    parts = substrings.longer_owners(held, 100, substrings.OWNER)
    assert whole > 64 and parts.selectExpr("sum(place & 255)").first()[0] == windows
    assert parts.count() <= substrings.CUTS * whole < windows / 2
