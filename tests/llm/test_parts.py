"""Building blocks: sorting, sketch, hashes, components, edit distance, trees, ZIP and WARC, DOM extraction."""

import gzip
import io
import random
import struct
import time
import zipfile
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import line_dedup, main_text, sketch, suffix_dedup, warc_zip
from strata.llm import textbatch as tb
from strata.llm.components import components
from strata.llm.ship import ship
from strata.llm.trees import BoostedTrees
from tests.llm import brute

SHORT = st.lists(st.binary(max_size=30).map(lambda b: b.translate(bytes(x % 3 for x in range(256)))), max_size=80)


@settings(max_examples=60, deadline=None)
@given(SHORT, st.sampled_from([8, 16]))
def test_deep_shallow_sorts(texts, shallow):
    order, lcp = suffix_dedup.deep_shallow(texts, shallow)
    assert [texts[i] for i in order] == sorted(texts)
    for k in range(1, len(texts)):
        a, b = texts[order[k - 1]], texts[order[k]]
        same = next((n for n in range(min(len(a), len(b))) if a[n] != b[n]), min(len(a), len(b)))
        assert lcp[k] == same


def test_large_groups_pass_the_quicksort():
    rng = random.Random(2)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 90))) for _ in range(600)] + [b"a" * 80] * 40
    order, _ = suffix_dedup.deep_shallow(texts, 16)
    assert [texts[i] for i in order] == sorted(texts)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 50), max_size=120), st.integers(1, 20))
def test_window_minimum_is_the_leftmost(values, width):
    keys = np.array(values, np.uint64) << np.uint64(30)
    got = tb.sliding_argmin(keys, width)
    assert got.tolist() == [k + values[k: k + width].index(min(values[k: k + width]))
                            for k in range(len(values) - width + 1)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=" \t\nab.é日", max_size=20)), max_size=8))
def test_words_of_a_batch(texts):
    data, offsets = tb.buffers(pa.array(texts, pa.string()))
    start, end, first = tb.words(data, offsets)
    found = [data[a:b].tobytes().decode() for a, b in zip(start, end)]
    assert [found[i:j] for i, j in zip(first[:-1], first[1:])] == [brute.words(t) for t in texts]


def test_sketch_loses_no_repeated_key(spark):
    ship(spark)
    keys = tb.mix(np.arange(20000, dtype=np.uint64) % np.uint64(15000))
    df = spark.createDataFrame([(int(k),) for k in keys.view(np.int64)], "k long").repartition(5)
    packed = sketch.repeated_bits(df, lambda batches: (b.column("k").to_numpy().view(np.uint64) for b in batches), 20)
    maybe = sketch.maybe_repeated(np.unique(keys), packed, 20)
    count = Counter(keys.tolist())
    twice = np.array([count[k] > 1 for k in np.unique(keys).tolist()])
    assert maybe[twice].all() and maybe[~twice].mean() < 0.05


def test_components_match_union_find(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(400 + k, 401 + k) for k in range(60)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    assert got == brute.groups(nodes, [e for e in edges if e[0] != e[1]])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("k", [1, 2, 3])
def test_banded_edit_distance(spark, k):
    rng, rows = random.Random(k), []
    for _ in range(600):
        a = [rng.choice("abc") for _ in range(rng.randint(0, 12))]
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(b) + 1)
            b[at: at + rng.randint(0, 1)] = [rng.choice("abc")] * rng.randint(0, 1)
        rows.append((max(a, b, key=len), min(a, b, key=len)) if len(a) != len(b) else (a, b))
    got = spark.createDataFrame(rows, "x array<string>, y array<string>").select(
        "x", "y", line_dedup.within(F.col("x"), F.col("y"), k).alias("w")).collect()
    assert all(r["w"] == (brute.edits(r["x"], r["y"]) <= k) for r in got)


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 6))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    model = BoostedTrees().fit(x[:2000], y[:2000])
    assert ((model.log_odds(x[2000:]) > 0) == (y[2000:] > 0)).mean() > 0.95


# ---- archives ---------------------------------------------------------------------------

PAGES = [(1, "http://a/1", "x" * 1500), (2, "http://a/2", "x" * 1500), (3, None, "x" * 1500), (3, "http://a/3b", "x" * 1500),
         (4, "http://a/4", "é" * 499), (5, "http://a/5", "é" * 499), (6, "", None), (7, "http://a/7", ""),
         (None, "http://a/8", "x" * 1500), (9, "http://a/9", "only " * 300)]


def test_archives_round_trip(spark):
    ship(spark)
    df = spark.createDataFrame([(*p, "extra") for p in PAGES], "page_id long, url string, html string, refers_to string")
    folder = warc_zip.fresh_path(spark, "test")
    manifest = warc_zip.write_archives(warc_zip.with_revisits(df), folder, archive_bytes=1500)
    got = warc_zip.read_archives(manifest, folder, range_bytes=600).collect()
    assert len(got) == len(PAGES) and manifest.count() > 1
    kinds = Counter((r["page_id"], r["record_type"], r["refers_to"]) for r in got)
    assert kinds == Counter({(1, "revisit", 3): 1, (2, "revisit", 3): 1, (3, "response", None): 2, (4, "response", None): 1,
                             (5, "response", None): 1, (6, "response", None): 1, (7, "response", None): 1,
                             (None, "revisit", 3): 1, (9, "response", None): 1})
    assert {r["payload"] for r in got if r["page_id"] == 5} == {("é" * 499).encode()}
    assert all(r["payload_bytes"] == 1500 for r in got if r["page_id"] in (1, 2, 3, None))
    assert warc_zip.round_trip(df.limit(0)).count() == 0


def archive(index=True, records=((1, b"one"), (2, b"two two"))):
    out, parts, lines, at = io.BytesIO(), [], [], 0
    for n, payload in records:
        one = warc_zip.gzip.compress(warc_zip.record(n, f"http://a/{n}", payload, None))
        lines.append({"filename": "data.warc.gz", "offset": at, "length": len(one)})
        parts.append(one)
        at += len(one)
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        with z.open(zipfile.ZipInfo("archive/data.warc.gz"), "w", force_zip64=True) as f:
            f.write(b"".join(parts))
        if index:
            z.writestr("indexes/index.cdxj", "".join(f"com,a)/ 2000 {warc_zip.json.dumps(x)}\n" for x in lines))
    return out.getvalue()


def zip64(raw):
    """The same archive with its directory described by ZIP64 records, as one past 4 GB would be."""
    end = raw.rfind(b"PK\x05\x06")
    count, size, start = struct.unpack("<HLL", raw[end + 10: end + 20])
    entry = bytearray(raw[start: start + size])
    offset, = struct.unpack("<L", entry[42:46])
    n_name, n_extra = struct.unpack("<HH", entry[28:32])
    packed, plain = struct.unpack("<LL", entry[20:28])
    entry[20:28] = entry[42:46] * 0 + b"\xff" * 8
    entry[42:46] = b"\xff" * 4
    entry[30:32] = struct.pack("<H", 28)
    first = bytes(entry[:46 + n_name]) + struct.pack("<HHQQQ", 1, 24, plain, packed, offset)
    body = first + bytes(entry[46 + n_name + n_extra:])
    record = struct.pack("<4sQHHLLQQQQ", b"PK\x06\x06", 44, 45, 45, 0, 0, count, count, len(body), start)
    locator = struct.pack("<4sLQL", b"PK\x06\x07", 0, start + len(body), 1)
    return raw[:start] + body + record + locator + struct.pack("<4sHHHHLLH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF,
                                                               0xFFFFFFFF, 0xFFFFFFFF, 0)


@pytest.mark.parametrize("wide", [False, True])
@pytest.mark.parametrize("index", [False, True])
def test_directories_and_ranges(wide, index):
    raw = archive(index)
    f = pa.BufferReader(zip64(raw) if wide else raw)
    assert set(warc_zip.directory(f)) == {"archive/data.warc.gz"} | ({"indexes/index.cdxj"} if index else set())
    found = warc_zip.ranges(f, range_bytes=1)
    assert len(found) == (2 if index else 1)
    got = [warc_zip.parse_record(r)["payload"] for at, n, _ in found for r in warc_zip.records(warc_zip._read(f, at, n))]
    assert got == [b"one", b"two two"]


def test_damage_is_reported():
    with pytest.raises(ValueError):
        warc_zip.directory(pa.BufferReader(b"no archive"))
    whole = warc_zip.record(1, "u", b"payload", None)
    with pytest.raises(ValueError):
        warc_zip.parse_record(whole.replace(b"payload", b"pay10ad"))


# ---- pages ------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def trees():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("aeioustrnlmd") for _ in range(rng.randint(2, 9)))
    line = lambda: " ".join(word() for _ in range(rng.randint(4, 40))).capitalize() + "."
    sources = ["<article>" + "".join(f"<p>{line()}</p>" for _ in range(rng.randint(2, 12))) + "</article>"
               for _ in range(150)]
    return main_text.train(sources), sources


def test_training_templates_with_other_choices(trees):
    model, sources = trees
    rng, right, wrong, missed = random.Random(77), 0, 0, 0
    for s in sources[:80]:
        blocks = [t for t in main_text.parse(s).text if t]
        page, holds = main_text._truth(main_text.training_page(blocks, rng))
        got = Counter(main_text.decode(page, np.clip(model.log_odds(main_text.features([page])), -6, 6)))
        want = Counter(t for t, h, tag in zip(page.text, holds, page.tag) if h and tag == "#text")
        right += sum((got & want).values())
        wrong += sum((got - want).values())
        missed += sum((want - got).values())
    assert right / (right + wrong) > 0.95 and right / (right + missed) > 0.95


def test_labels_never_contradict(trees):
    page = main_text.parse("<nav><p>a</p></nav><article><h1>T</h1><p>b<div class=ad>c</div><p>d</article>")
    score = np.array([0.0 if t == "#root" else 2.0 for t in page.tag])
    score[page.tag.index("nav")] = -9.0
    assert main_text.decode(page, score) == ["T", "b", "c", "d"]


def test_decoding_is_the_best_of_all_labellings():
    """Against every set of text nodes; an element is accepted if one below it is, and costs or gives its score."""
    rng = random.Random(12)
    for _ in range(300):
        page = main_text.Page()
        for k in range(rng.randint(1, 10)):
            holders = [v for v in range(len(page.parent)) if page.tag[v] != "#text"]
            node = page.add(rng.choice(holders), rng.choice(["#text", "div", "p"]))
            page.text[node] = f"t{k}" if page.tag[node] == "#text" else ""
        score = np.array([rng.uniform(-2, 2) for _ in page.parent])
        leaves = [v for v, t in enumerate(page.tag) if t == "#text"]

        def worth(chosen):
            held = set()
            for v in chosen:
                while v > 0 and v not in held:
                    held.add(v)
                    v = page.parent[v]
            return sum(score[v] for v in held)

        best = max(worth([v for k, v in enumerate(leaves) if bits >> k & 1]) for bits in range(1 << len(leaves)))
        got = main_text.decode(page, score)
        assert worth([v for v in leaves if page.text[v] in got]) == pytest.approx(best)


@pytest.mark.parametrize("source", [
    "<a" * 60000 + '">', "<div>" * 30000 + "</p>" * 60000, "<svg>" * 60000, "<svg " * 60000, '<p title="' * 40000,
    "<!--" * 60000, "<script>" * 60000, "<div>" * 100000, "<p>" * 100000, "<li><ul>" * 40000, "=" * 200000 + "<x" + "= " * 100000])
def test_the_scanner_takes_linear_time(source):
    begin = time.process_time()
    page = main_text.parse(source)
    assert time.process_time() - begin < 3
    if len(page.parent) > 50000:
        assert main_text.features([page]).shape[0] == len(page.parent)


def test_records_take_linear_time():
    one = gzip.compress(warc_zip.record(1, "u", b"a page of text" * 20, None))
    begin = time.process_time()
    assert sum(1 for _ in warc_zip.records(one * 20000)) == 20000
    plain = warc_zip.record(1, "u", b"a page of text" * 20, None)
    assert list(warc_zip.records(plain * 20000)) == [plain] * 20000
    assert time.process_time() - begin < 6
    long = warc_zip.record(2, "u", random.Random(3).randbytes(100_000), None)
    assert list(warc_zip.records(gzip.compress(long) + one)) == [long, gzip.decompress(one)]
    with pytest.raises(ValueError):
        list(warc_zip.records(one[:-20]))


@pytest.mark.parametrize("source,blocks", [
    ('<p>one <svg class="i"/> two</p><p>three</p>', ["one two", "three"]),
    ("<p>a</p><iframe src=x><p>b</p><p>c</p>", ["a", "b", "c"]), ("<p>a</p><iframe src=x>no</iframe><p>b</p>", ["a", "b"]),
    ('<p>q <a title="x>bad</p><p>next', ["q bad", "next"]), ("<p title=it's>a</p><p>that's", ["a", "that's"]),
    ("<p>a<select><option>1</select>b<object>x<object>y</object>z</object>c", ["abc"]),
    ("<p>a</ x>b</>c <title>no</TITLE >d<textarea><p>no</textarea>e", ["abc de"]), ("a < b, c <3 and <", ["a < b, c <3 and <"]),
    ("", []), ("plain &amp; simple", ["plain & simple"]), ("<p>a<br>b  c<p>d", ["a b c", "d"]),
    ("<p>x &lt;b&gt; <b>y</b>z</p>", ["x <b> yz"]), ("<script>var a='<p>no</p>'</script><p>yes", ["yes"]),
    ("<!-- <p>no</p> --><ul><li>one<li>two</ul>", ["one", "two"]), ("<p>cut <a href='x", ["cut"]),
    ("<div title='a > b'>t</div><p>&copy &#233; &am", ["t", "© é &am"])])
def test_parsing(source, blocks):
    assert [t for t in main_text.parse(source).text if t] == blocks


def test_extraction_of_odd_pages(spark, trees):
    ship(spark)
    long = "<article>" + "<p>Some words, here and there.</p>" * 3000 + "</article>"
    rows = [(1, "u", None), (2, None, ""), (None, "v", "<p>x</p>"), (3, "w", long), (3, "w", long)]
    df = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    got = main_text.digest(main_text.extract(df, main_text.fit(df))).collect()
    assert len(got) == 5 and all(r["n_chars"] == len(r["text"]) for r in got)
    assert [r["text"] for r in got if r["page_id"] in (1, 2)] == ["", ""]
    assert len({r["text"] for r in got if r["page_id"] == 3}) == 1
    assert main_text.extract(df.limit(0), main_text.fit(df.limit(0))).count() == 0
