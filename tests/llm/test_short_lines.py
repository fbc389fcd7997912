"""Line dedup of short lines and of lines without spaces: equality of every line, near copies by characters."""

import random
from collections import Counter

from strata.llm import line_dedup
from tests.llm import brute


def expected(docs):
    """{(doc_id, line number)} removed under the default rules."""
    first, places = {}, []
    for i, t in sorted(docs):
        for n, line in enumerate(t.split("\n")):
            w = tuple(brute.words(line))
            if w:
                places.append((i, n, w))
                first.setdefault(w, (i, n))
    kinds, most = list(first), line_dedup.EDITS
    near = set()
    for x, a in enumerate(kinds):
        for b in kinds[x + 1:]:
            worded = len(a) >= line_dedup.MIN_WORDS
            if worded != (len(b) >= line_dedup.MIN_WORDS):
                continue
            u, v = (a, b) if worded else (" ".join(a), " ".join(b))
            limit = most if worded else min(most, min(len(u), len(v)) // line_dedup.PER_EDIT)
            if abs(len(u) - len(v)) <= limit and limit and brute.edits(u, v) <= limit:
                near.add(max(a, b, key=first.get))
    return {(i, n) for i, n, w in places if first[w] != (i, n) or w in near}


def near_pairs(docs):
    """First places of the distinct lines, all places, and every pair of distinct lines that are near."""
    first, places = {}, []
    for i, t in sorted(docs):
        for n, line in enumerate(t.split("\n")):
            w = tuple(brute.words(line))
            if w:
                places.append((i, n, w))
                first.setdefault(w, (i, n))
    kinds, most = list(first), line_dedup.EDITS
    pairs = []
    for x, a in enumerate(kinds):
        for b in kinds[x + 1:]:
            worded = len(a) >= line_dedup.MIN_WORDS
            if worded != (len(b) >= line_dedup.MIN_WORDS):
                continue
            u, v = (a, b) if worded else (" ".join(a), " ".join(b))
            limit = most if worded else min(most, min(len(u), len(v)) // line_dedup.PER_EDIT)
            if abs(len(u) - len(v)) <= limit and limit and brute.edits(u, v) <= limit:
                pairs.append((a, b))
    return first, places, pairs


def links_by_doc(docs):
    """{doc_id: near lines of its lines, all of them}"""
    _, places, pairs = near_pairs(docs)
    ends = Counter(w for pair in pairs for w in pair)
    found = Counter({i: 0 for i, _ in docs})
    for i, _, w in places:
        found[i] += ends[w]
    return dict(found)


def removed(spark, docs):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    return {(r["doc_id"], n) for r in line_dedup.report(frame).collect() for n in r["removed"]}


def test_short_and_space_free_lines(spark):
    script = "東京都の冬の川は静かで石の橋に光がさす"
    docs = [(1, "All rights reserved.\n\nno\n" + script + "\nthe cat sat on the mat"),
            (2, "All rights reserved.\n\nno\n" + script + "\nthe cat sat on a mat"),
            (3, "All rights reserved!\n \nna\n" + script[:9] + "夏" + script[10:] + "\nwe met by the old mill"),
            (4, "one two three four five six seven eight\nabc"),
            (5, "one two three 4 five six seven eight\nabd")]
    got = removed(spark, docs)
    assert got == {(2, 0), (2, 2), (2, 3), (3, 0), (3, 3), (5, 0)} == expected(docs)


def test_negative_and_great_doc_ids(spark):
    docs = [(-(2**63), "first line\nshared words"), (-5, "x\ny\nshared words"), (-4, "first line\ny"),
            (2**62, "x\nfirst line"), (2**63 - 2, "only here")]
    assert removed(spark, docs) == expected(docs) == {(-5, 2), (-4, 0), (-4, 1), (2**62, 0), (2**62, 1)}


def test_random_short_lines_match_brute_force(spark):
    rng = random.Random(5)
    made = ["".join(rng.choice("abcd ") for _ in range(rng.randint(1, 40))) for _ in range(60)]
    for _ in range(120):
        line = list(rng.choice(made))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(line) + 1)
            line[at: at + rng.randint(0, 1)] = rng.choice(["", "a", "b ", "e"])
        made.append("".join(line))
    docs = [(k, "\n".join(made[k::20])) for k in range(20)]
    want = expected(docs)
    assert len(want) > 40
    assert removed(spark, docs) == want


def variants(rng, n):
    """Documents around a few base lines: copies with up to three words replaced, some before the line itself."""
    bases = [" ".join(f"{rng.choice('abcdefgh')}{rng.randrange(30)}" for _ in range(12)) for _ in range(2)]
    docs = []
    for k in range(n):
        lines = []
        for base in bases:
            w = base.split()
            for _ in range(rng.choice([0, 1, 1, 2, 3]) if k else 2):
                w[rng.randrange(12)] = f"x{rng.randrange(40)}"
            lines.append(" ".join(w))
        docs.append((k, "\n".join(lines)))
    return docs


def test_long_lists_by_hubs_remove_the_same_lines(spark, monkeypatch):
    docs = variants(random.Random(9), 40)
    want = expected(docs)
    for wide in (0, 2, 1000):
        monkeypatch.setattr(line_dedup, "WIDE", wide)
        assert removed(spark, docs) == want
    assert len(want) > 50


def test_all_pairs_of_a_group_of_near_copies_are_linked(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "WIDE", 4)
    links = {}
    for n in (30, 120):
        docs = [(k, " ".join([f"w{j}" if j != k % 12 else f"x{k}" for j in range(12)])) for k in range(n)]
        frame = spark.createDataFrame([*docs, (n, " ".join(f"w{j}" for j in range(12)))], "doc_id long, text string")
        report = line_dedup.report(frame.orderBy("doc_id")).collect()
        assert sum(r["n_removed"] for r in report) == n
        links[n] = sum(r["n_links"] for r in report)
    assert links == {30: 31 * 30, 120: 121 * 120}  # any two differ by two words at most


def test_every_link_is_counted_in_short_and_long_lists(spark, monkeypatch):
    docs = variants(random.Random(9), 40)
    docs += [(100 + k, t + "\n" + t.split("\n")[0]) for k, t in docs[:3]] + [(200, "no line like this one is anywhere near here")]
    want = links_by_doc(docs)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for wide, block in ((0, 7), (2, 256), (2, 1), (1000, 256)):
        monkeypatch.setattr(line_dedup, "WIDE", wide)
        monkeypatch.setattr(line_dedup, "BLOCK", block)
        assert {r["doc_id"]: r["n_links"] for r in line_dedup.report(frame).collect()} == want
    assert sum(want.values()) > 500


def test_links_of_random_short_lines_match_brute_force(spark, monkeypatch):
    rng = random.Random(6)
    made = []
    for _ in range(8):
        base = "".join(rng.choice("abcd ") for _ in range(rng.randint(14, 30)))
        for _ in range(12):
            line = list(base)
            for _ in range(rng.randint(0, 2)):
                at = rng.randrange(len(line) + 1)
                line[at: at + rng.randint(0, 1)] = rng.choice(["", "a", "b ", "e"])
            made.append("".join(line))
    docs = [(k, "\n".join(made[k::10])) for k in range(10)]
    want = links_by_doc(docs)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for wide in (0, 3, 1000):
        monkeypatch.setattr(line_dedup, "WIDE", wide)
        monkeypatch.setattr(line_dedup, "BLOCK", 4)
        assert {r["doc_id"]: r["n_links"] for r in line_dedup.report(frame).collect()} == want
