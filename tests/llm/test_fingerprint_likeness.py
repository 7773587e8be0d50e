"""Likeness of fingerprints against brute-force generalised Jaccard, with heavy repeated words."""

from collections import Counter

import pytest

from tidalfed.llm import fingerprints

PAIRS = 40


def generalised_jaccard(a, b):
    one, two = (Counter(zip(w, [*w[1:], None])) for w in (a.split(), b.split()))
    terms = one.keys() | two.keys()
    return sum(min(one[t], two[t]) for t in terms) / sum(max(one[t], two[t]) for t in terms)


def words(name, number):
    return " ".join(f"{name}x{i}" for i in range(number))


CASES = {
    "heavy pair in both": lambda i: (
        f"h{i} " * 901 + words(f"a{i}", 100), f"h{i} " * 901 + words(f"b{i}", 100)),
    "heavy pair in one": lambda i: (
        f"h{i} " * 901 + words(f"a{i}", 100), words(f"a{i}", 100)),
    "heavy pair of two weights": lambda i: (
        f"h{i} " * 301 + words(f"a{i}", 100), f"h{i} " * 601 + words(f"a{i}", 60)),
    "single pairs": lambda i: (
        words(f"a{i}", 100), words(f"a{i}", 60) + " " + words(f"b{i}", 40)),
}


@pytest.mark.parametrize("case", sorted(CASES))
def test_likeness_is_generalised_jaccard(spark, case):
    pairs = [CASES[case](i) for i in range(PAIRS)]
    rows = [(2 * i + k, text) for i, pair in enumerate(pairs) for k, text in enumerate(pair)]
    got = {r["doc_id"]: r["near_next"] for r in fingerprints.fingerprints(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    exact = sum(generalised_jaccard(*pair) for pair in pairs) / PAIRS
    # 64 draws of each pair: the mean's standard deviation is at most 0.01.
    assert abs(sum(got[2 * i] for i in range(PAIRS)) / PAIRS - exact) < 0.04


def test_texts_and_signatures_stay_in_their_slices(spark):
    docs = spark.createDataFrame([(i, words(f"a{i}", 20)) for i in range(50)],
                                 "doc_id long, text string")
    plan = fingerprints.fingerprints(docs, slice_bytes=500)._jdf.queryExecution().toString()
    physical = plan.split("== Physical Plan ==")[1]
    dealt = [line for line in physical.splitlines() if "Exchange hashpartitioning" in line]
    assert dealt and not any("_place" in line for line in dealt)
    assert "collect_list" not in physical and "Join" not in physical


def test_left_out_samples_change_nothing(spark):
    texts = [None, "", " \n", "one", words("a", 30), words("a", 400), "x " * 300 + words("b", 50),
             words("a", 200) + " " + words("c", 200), "y " * 40, words("é", 60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    # None left out, some (most draws keep one, some texts lack one), and all.
    every, some, no = (sorted(map(tuple, fingerprints.fingerprints(docs, most=m).collect()))
                       for m in (1e9, 3.0, 1e-9))
    assert every == some == no and len(every) == len(texts)
    plan = fingerprints.fingerprints(docs)._jdf.queryExecution().optimizedPlan().toString()
    # Logarithms are taken of rows that a filter without any has left.
    assert any("Filter" in line and "xxhash64" in line and "ln(" not in line
               for line in plan.splitlines())
