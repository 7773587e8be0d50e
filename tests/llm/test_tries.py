"""The trie of conversation prefixes against a plain build, at any segment and shard size."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tidalfed.llm import tries

SCHEMA = "conv_id long, turn long, role string, text string, depth int, ends string, key string"
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
          "saved_tokens", "ends_sha256"]


def brute_force(rows):
    turns = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns[conv_id].append((turn is not None, turn or 0, tie, (role, text)))
    lines = {c: [t[-1] for t in sorted(ts)] for c, ts in turns.items()}
    members, ending = defaultdict(list), defaultdict(list)
    for c, line in lines.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        path = tuple(lines.get(base, [])[:h] + line[h:])
        for depth in range(len(path) + 1):
            members[path[:depth]].append(c)
        ending[path].append(c)
    children, leaves, saved = (defaultdict(int) for _ in range(3))
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, convs in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for depth in range(len(node) + 1):
            saved[node[:depth]] += (len(convs) - 1) * words
            leaves[node[:depth]] += not children[node]
    return sorted(
        (min(convs), len(node), min(members[node[:-1]]) if node else -1, len(convs),
         children[node], leaves[node], saved[node],
         hashlib.sha256(",".join(map(str, sorted(ending[node]))).encode()).hexdigest())
        for node, convs in members.items())


def trie(spark, rows, **options):
    frame = spark.createDataFrame([(*r, 1, "e", "k") for r in rows], SCHEMA)
    return sorted(tuple(-1 if x is None else x for x in r) for r in
                  tries.prefix_trie(frame, **options).select(*RESULT).collect())


def talks(seed, n):
    """Conversations that share heads, whole copies, one that is most of the table."""
    draw = random.Random(seed)
    rows, line = [], [(f"r{i % 2}", f"shared words {i}") for i in range(30)]
    for c in range(n):
        kind = draw.random()
        if kind < 0.3:
            path = line[:20]
        elif kind < 0.6:
            path = line[:draw.randint(0, 12)] + [("user", f"own {draw.randint(0, 3)} {c % 3}")] * (
                draw.randint(0, 3))
        else:
            path = [("user", draw.choice("abcd")) for _ in range(draw.randint(0, 6))]
        rows += [(c, t, *x) for t, x in enumerate(path)]
    rows += [(n + 5, t, "user", f"long {t}") for t in range(40)]
    rows += [(n + 45, t, "user", f"long {t}") for t in range(33)]
    draw.shuffle(rows)
    return rows


ODD = [(1, None, "user", "first by null"), (1, 0, None, None), (1, 0, "user", ""),
       (1, 0, "user", ""), (1, 5, "user", "two\x0bwords here"), (None, 0, "user", "nobody"),
       (2, 0, "user", "only a head"), (40, 0, "a", "b c"), (41, 0, "a", "b c"),
       (41, 1, "x", "end"), (-25, 0, "a", "b c"), (-20, 0, "m", "n"), (-20, 1, "m", "n"),
       (60, 0, "ab", "c"), (80, 0, "a", "bc"), (100, 0, "user", "word " * 200_000)]


@pytest.mark.parametrize("options", [
    {}, {"segment": 4, "shard_turns": 15}, {"segment": 7, "shard_turns": 1},
    {"segment": 1024, "shard_turns": 200}])
def test_against_plain_build(spark, options):
    rows = talks(1, 300) + [(r[0] and r[0] + 1000, *r[1:]) for r in ODD]
    assert trie(spark, rows, **options) == brute_force(rows)


@pytest.mark.parametrize("segment", [2, 1024])
def test_odd_rows(spark, segment):
    assert trie(spark, ODD, segment=segment) == brute_force(ODD)


def test_empty_tables(spark):
    assert trie(spark, []) == []
    assert trie(spark, [(None, 1, "user", "x")]) == []


def test_one_conversation_many_times(spark):
    rows = [(c, t, "user", f"same {t}") for c in range(0, 6000, 20) for t in range(3)]
    got = trie(spark, rows, segment=2, shard_turns=50)
    assert got == brute_force(rows) and len(got) == 4


def test_double_array_walks_to_every_node():
    draw = random.Random(5)
    paths = sorted({tuple(draw.randint(0, 40) for _ in range(draw.randint(1, 6)))
                    for _ in range(3000)})
    sizes = np.array([len(p) for p in paths])
    starts = np.cumsum(sizes) - sizes
    array = tries.DoubleArray(np.concatenate([np.array(p) for p in paths]), starts, sizes)
    seen = {}
    for path in paths:
        at = np.zeros(1, np.int64)
        for depth, code in enumerate(path):
            at = array.step(at, np.array([code]))
            assert at[0] > 0 and seen.setdefault(path[:depth + 1], at[0]) == at[0]
    assert len(set(seen.values())) == len(seen)
    assert (array.step(np.array(list(seen.values())), np.full(len(seen), 41)) == -1).all()
    assert len(array.used) < 4 * len(seen)
